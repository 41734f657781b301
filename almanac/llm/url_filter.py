"""URL filters: rules by host and path, and logistic regression over hashed character n-grams.

Host and path are cut into their overlapping runs of 3 to 5 letters (the host between marks for
its borders), hashed into a fixed number of places and weighed by a logistic regression. It is
trained on a small table of labelled URLs, a parameter; the list below is the default. Training
and scoring run in Spark ML, on the JVM, and a page is judged within its row, so no
shuffle takes place and a frequent host is no hot key.
"""

from __future__ import annotations

import string

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import quoted, table, without

ALLOW, BLOCK = "allow", "block"
# (verdict, host, path): fits the host and its subdomains where the path starts alike.
RULES = [
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
]
SIZES = (3, 4, 5)
PLACES = 1 << 16
PENALTY = 0.002
THRESHOLD = 0.5
# A labelled table is read by one task when the model is fitted; more rows than this are refused.
MOST_LABELLED = 100_000

# Hosts and paths of both kinds, as a person would list them by hand; every word is an invented site.
_BLOCKED = """
casino-royal.example/play casino.example/slots/777 www.best-casino.example/bonus/free-spins online-casino24.example/
m.luckycasino.example/jackpot bigwin-casino.example/en/welcome.html free-spins.example/bonus mega-slots.example/win
poker-room.example/tables/1 www.pokerbets.example/odds sportsbet.example/live betting-tips.example/today free-bet.example/en/
bets365.example/football quickbets.example/ bet-now.example/en/10 www.bingo-jackpot.example/free roulette-win.example/play
win-prizes.example/claim?id=1 you-win.example/iphone lottery-winner.example/claim winbig.example/now free-winnings.example/
cheap-viagra.example/buy buy-pills.example/order pills-online.example/cheap/ www.diet-pills.example/ cheapmeds.example/pharmacy
online-pharmacy.example/no-prescription cheap-cialis.example/ m.pillstore.example/en/3 weightloss-pills.example/offer
cheap-watches.example/replica replica-bags.example/cheap cheap-loans.example/apply payday-loans.example/fast easycredit-cheap.example/
adult-chat.example/ www.adult-video.example/free adultdating.example/signup xxx-tube.example/watch free-xxx.example/video/1
sexcams.example/live hot-porn.example/hd pornvideos.example/ m.adult-cams.example/room/5 adult-xxx.example/en/2 nude-cams.example/
www.adult-movies.example/fr/31 adults-only.example/de/18 blog.adultfun.example/es/29 sex-shop.example/fr/6 xxx-adult.example/de/77
ads-server.example/banner ads.example/click?id=5 www.ad-track.example/pixel adtracker.example/pixel.gif ads-click.example/en/77
track-ads.example/imp?c=1 click-tracker.example/redirect tracking-pixel.example/t.gif popup-ads.example/show adserver.example/banner/3
m.ads-network.example/en/ trackclicks.example/ affiliate-track.example/go spyware-track.example/a banner-ads.example/728x90
spam-links.example/ seo-spam.example/backlinks www.link-farm.example/page/9 spamblog.example/en/88 content-farm.example/post
linkfarm.example/buy-links spammer.example/list cheap-backlinks.example/seo article-spam.example/spin spam-mail.example/send
www.spam-site.example/de/41 blog.spam-pages.example/fr/520 spam-network.example/es/63 click-farm.example/fr/14 bot-farm.example/de/9
free-download-crack.example/keygen crack-serial.example/full warez.example/iso phishing-login.example/verify-account
secure-bank-login.example/update malware-site.example/install.exe virus-alert.example/scan fake-antivirus.example/download
"""
_ALLOWED = """
www.citylibrary.example/en/catalog university.example/courses/physics blog.gardening.example/en/2021/tomatoes news.example/world
museum.example/exhibitions/3 www.townhall.example/services recipes.example/bread/rye weather.example/forecast/berlin
docs.example/manual/install wiki.example/en/History m.newspaper.example/politics/4711.html school.example/en/teachers
www.hospital.example/visiting-hours railway.example/timetable forum.cycling.example/thread/88 blog.astronomy.example/en/mars
alphabet.example/letters tibet.example/travel betterhomes.example/kitchen betalingen.example/info diabetes.example/help
windows.example/repair winter.example/sports winery.example/en/wines twins.example/family edwin.example/blog darwin.example/species
roads.example/maps loads.example/freight readers.example/en/novels adsorption.example/chemistry adobe-house.example/build
soundtrack.example/film racetrack.example/history trackandfield.example/results tractors.example/parts attractions.example/city
essex.example/council middlesex.example/school adulteducation.example/courses farmersmarket.example/en/eggs old-mill.example/grain
dairyfarm.example/milk farmhouse.example/rooms spanish.example/lessons spam-filter-docs.example/help caspian.example/sea
cheapside.example/london cheaper-energy.example/advice freedom.example/rights freeway.example/traffic freelance.example/jobs
linkedlists.example/algorithms clickstream-paper.example/pdf poems.example/fr/verlaine musique.example/fr/concerts
www.theatre.example/fr/saison mairie.example/fr/horaires blog.cuisine.example/fr/soupe rathaus.example/de/termine
www.bibliothek.example/de/katalog verein.example/de/satzung m.zeitung.example/de/politik/12.html wandern.example/de/wege
ayuntamiento.example/es/servicios www.biblioteca.example/es/libros m.diario.example/es/cultura/7 recetas.example/es/pan
thenorth.example/en/1 www.therapy.example/en/22 blog.thistle.example/en/303 thunder.example/en/4044.html m.thread.example/en/51/
throne.example/en/77?page=2 another.example/de/6100 nation.example/fr/811 motion.example/en/920.html station.example/es/10
blog.stations.example/en/1234/ tension.example/de/55 www.thorough.example/fr/66 m.thesis.example/es/707 theory.example/en/8088
shore.example/en/91 andes.example/es/102 ounce.example/en/113 herbs.example/de/124.html notation.example/fr/135 stone.example/en/146
"""


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; then up to `?`, `#`
    or the end. Both are empty for null and for text without `://`."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    given = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(given, pattern, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.regexp_extract(given, pattern, 2)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null without one. Equally long rules go by their text.

    The list becomes one expression, so it should be one written by hand, of up to some hundreds.
    """
    fits, verdicts = [], []
    for verdict, of_host, of_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        hit = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(of_path)
        fits.append(F.when(hit, F.lit(of_host + of_path)))
        verdicts.append(F.when(hit, F.lit(verdict)))
    nothing = F.lit(None).cast("string")
    return F.coalesce(*fits, nothing), F.coalesce(*verdicts, nothing)


def grams(host: Column, path: Column) -> Column:
    """The character n-grams of host and path; what a gram is part of is its first letter."""

    def of(text: Column, mark: str) -> Column:
        every = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in SIZES]
        return F.transform(F.concat(*every), lambda g: F.concat(F.lit(mark), g))

    return F.concat(of(F.concat(F.lit("^"), host, F.lit("$")), "h"), of(F.lower(path), "p"))


def _featured(urls: DataFrame, url: str) -> DataFrame:
    host, path = split_url(quoted(url))
    return urls.withColumn("_grams", grams(host, path))


def default_labels(spark: SparkSession) -> DataFrame:
    """The labelled table: url and label, 1 for blocked."""
    rows = [(f"https://{u}", label) for label, texts in ((1, _BLOCKED), (0, _ALLOWED)) for u in texts.split()]
    return spark.createDataFrame(rows, "url string, label int")


def train(labelled: DataFrame) -> PipelineModel:
    """Fit the filter on url and label (1 for blocked); rows without either are left out.

    A table without both labels cannot be learned from and is refused, as is one of more
    than `MOST_LABELLED` rows.
    """
    given = labelled.select("url", F.col("label").cast("double").alias("label")).dropna()
    sizes = given.agg(F.count("label").alias("n"), F.count_distinct("label").alias("labels")).first()
    if sizes["labels"] < 2 or sizes["n"] > MOST_LABELLED:
        raise ValueError(f"need two labels and at most {MOST_LABELLED} rows, got {sizes['labels']} and {sizes['n']}")
    # a small table in one partition and a fixed order, so that every fit sums in the same order
    rows = _featured(given, "url").coalesce(1).sortWithinPartitions("url", "label")
    hashing = HashingTF(inputCol="_grams", outputCol="_places", numFeatures=PLACES, binary=True)
    regression = LogisticRegression(
        featuresCol="_places", labelCol="label", probabilityCol="_probability", rawPredictionCol="_raw",
        predictionCol="_predicted", regParam=PENALTY, standardization=False, maxIter=60,
    )
    return Pipeline(stages=[hashing, regression]).fit(rows)


def judge_urls(
    pages: DataFrame, model: PipelineModel, rules: list[tuple[str, str, str]] = RULES, url: str = "url"
) -> DataFrame:
    """Add host, path, rule, score (0 to 1, higher: block likelier) and verdict to rows with a url.

    A rule decides where one fits, else the score. Null, empty and unreadable urls have
    empty host and path; no gram speaks for or against them, so the model's base rate decides.
    Columns of these names are replaced, others kept; rows stay as they are, an empty table stays empty.
    """
    added = {"host", "path", "rule", "score", "verdict", "_grams", "_places", "_raw", "_probability", "_predicted"}
    if url.lower() in added:
        raise ValueError(f"the column of urls must not be called {url}")
    host, path = split_url(quoted(url))
    scored = model.transform(_featured(without(pages, *added), url))
    scored = scored.withColumns(
        {"host": host, "path": path, "score": vector_to_array(F.col("_probability")).getItem(1)}
    ).drop("_grams", "_places", "_raw", "_probability", "_predicted")
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") >= THRESHOLD, BLOCK).otherwise(ALLOW)
    return scored.withColumns({"rule": rule, "verdict": F.coalesce(said, own)})


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages, train(default_labels(spark)))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


QUERIES = {"op13_url_filter": op13_url_filter}
ORACLE: dict[str, str] = {}
