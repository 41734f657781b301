"""Country dimension and the lookup of free-text names in it.

A dimension is a frame with `name`, `alpha_2`, `alpha_3` and optionally `official_name`,
`common_name`, `numeric`. Pass one read from the standard's own table for its exact names;
`default_countries` derives one from the locale data shipped with the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Short names in notices and the standard's name for them (fixed values).
ALIASES = {
    "bolivia": "Bolivia, Plurinational State of",
    "venezuela": "Venezuela, Bolivarian Republic of",
    "iran": "Iran, Islamic Republic of",
    "syria": "Syrian Arab Republic",
    "tanzania": "Tanzania, United Republic of",
    "laos": "Lao People's Democratic Republic",
    "south korea": "Korea, Republic of",
    "north korea": "Korea, Democratic People's Republic of",
    "ivory coast": "Côte d'Ivoire",
    "arabia": "Saudi Arabia",
}

# ISO 3166 names that differ from the JVM's display names (fixed values).
STANDARD_NAMES = {
    "BN": "Brunei Darussalam",
    "BO": "Bolivia, Plurinational State of",
    "CD": "Congo, The Democratic Republic of the",
    "CG": "Congo",
    "CI": "Côte d'Ivoire",
    "CV": "Cabo Verde",
    "FK": "Falkland Islands (Malvinas)",
    "FM": "Micronesia, Federated States of",
    "HK": "Hong Kong",
    "IR": "Iran, Islamic Republic of",
    "KP": "Korea, Democratic People's Republic of",
    "KR": "Korea, Republic of",
    "LA": "Lao People's Democratic Republic",
    "MD": "Moldova, Republic of",
    "MM": "Myanmar",
    "MO": "Macao",
    "PS": "Palestine, State of",
    "RU": "Russian Federation",
    "SY": "Syrian Arab Republic",
    "TR": "Türkiye",
    "TW": "Taiwan, Province of China",
    "TZ": "Tanzania, United Republic of",
    "US": "United States",
    "VA": "Holy See (Vatican City State)",
    "VC": "Saint Vincent and the Grenadines",
    "VE": "Venezuela, Bolivarian Republic of",
    "VG": "Virgin Islands, British",
    "VI": "Virgin Islands, U.S.",
    "VN": "Viet Nam",
}

# Official names that no rule gives, and the standard's name for them (fixed values).
OFFICIAL_NAMES = {
    "united states of america": "United States",
    "czech republic": "Czechia",
    "slovak republic": "Slovakia",
    "swiss confederation": "Switzerland",
    "french republic": "France",
    "hellenic republic": "Greece",
    "italian republic": "Italy",
    "portuguese republic": "Portugal",
    "argentine republic": "Argentina",
    "gabonese republic": "Gabon",
    "togolese republic": "Togo",
    "lebanese republic": "Lebanon",
    "kyrgyz republic": "Kyrgyzstan",
    "united mexican states": "Mexico",
}

# The form of a state before its name, as in "Federal Republic of ..." or "Kingdom of the ...".
STATE_FORM = (
    r"^(?:the )?(?:[a-z'’-]+ ){0,4}(?:republic|kingdom|state|states|commonwealth|federation|principality|sultanate|"
    r"union|duchy) of (?:the )?(?=.)"
)

LOOKUP_COLUMNS = ["alpha_2", "alpha_3", "numeric", "name", "common_name", "official_name"]


def default_countries(spark: SparkSession) -> DataFrame:
    """One row per ISO 3166 country known to the JVM (about 250)."""
    locale = spark._jvm.java.util.Locale
    rows = []
    for code in locale.getISOCountries():
        place = locale("", code)
        shown = place.getDisplayCountry(locale.ENGLISH)
        # the standard writes these words out
        shown = shown.replace(" & ", " and ").replace("St. ", "Saint ").replace("São Tomé and Príncipe", "Sao Tome and Principe")
        rows.append((STANDARD_NAMES.get(code, shown), code, place.getISO3Country(), shown))
    return spark.createDataFrame(rows, "name string, alpha_2 string, alpha_3 string, common_name string")


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """A dimension stored as CSV with header or as Parquet."""
    if path.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    return spark.read.parquet(path)


def country_keys(countries: DataFrame) -> DataFrame:
    """Every lower-case text that names a country, with its struct (name, alpha_2, alpha_3).

    A name such as "Korea, Republic of" is a key in its other order too. Of countries that share a
    text the first by name is taken. Aliases and official names follow the standard's name they stand for.
    """
    columns = [c for c in LOOKUP_COLUMNS if c in countries.columns]
    head, tail = (F.regexp_extract("name", r"^([^,]+), ([^,]+)$", i) for i in (1, 2))
    turned = F.when(tail != "", F.regexp_replace(F.lower(F.concat_ws(" ", tail, head)), "^the ", ""))
    given = [*[F.lower(F.col(c).cast("string")) for c in columns], turned]
    keys = (
        countries.select(
            F.explode(F.array(*given)).alias("key"),
            F.struct("name", "alpha_2", "alpha_3").alias("country"),
        )
        .where("key is not null")
        .groupBy("key")
        .agg(F.min("country").alias("country"))
    )
    other = ALIASES | OFFICIAL_NAMES
    names = F.create_map(*[F.lit(x) for alias, name in other.items() for x in (name.lower(), alias)])
    short = keys.select(names[F.col("key")].alias("key"), "country").where("key is not null")
    longer = keys.where(~F.col("key").isin(*other)).unionByName(
        keys.where(F.col("key").isin(*other)).join(short.select("key"), "key", "left_anti")
    )
    return longer.unionByName(short)


def with_country(df: DataFrame, title: str, candidates: Column, countries: DataFrame, name: str) -> DataFrame:
    """Add the country of a title as a struct: the first of its candidate texts that names one.

    Candidates that name none are tried again without the form of state before the name. Each
    distinct title is looked up once, by an equality join on its candidates that the runtime sends
    the keys to or shuffles, by their size. Rows without a title do not take part in it.
    """
    given = df.where(F.col(title).isNotNull())
    titles = given.select(F.col(title).alias("_title"), candidates.alias("_texts")).distinct()
    formless = F.transform("_texts", lambda t: F.regexp_replace(t, STATE_FORM, ""))
    texts = titles.select("_title", F.posexplode(F.concat("_texts", formless)).alias("_place", "key"))
    found = texts.join(country_keys(countries), "key").groupBy("_title").agg(
        F.min_by("country", "_place").alias(name)
    )
    named = given.join(found, given[title] == found["_title"], "left").drop("_title")
    untitled = df.where(F.col(title).isNull()).withColumn(name, F.lit(None).cast(found.schema[name].dataType))
    return named.unionByName(untitled)
