import json

import pytest
from pyspark.sql import functions as F

from almanac.functions import compat, dates, numbers, text
from almanac.functions.countries import default_countries, with_country
from almanac.operators import documents as docs
from almanac.operators import indicators as ind
from almanac.operators import shape
from almanac.plans import dashboards as dash
from almanac.sources import documents as raw


def bodies(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc int, body string")


def test_gho(spark):
    records = [
        {"SpatialDim": "NGA", "TimeDim": 2020, "NumericValue": 300.1, "IndicatorCode": "M"},
        {"SpatialDim": "NGA", "TimeDim": None, "NumericValue": 1, "IndicatorCode": "M"},
        {"SpatialDim": "NGA", "TimeDim": "early", "NumericValue": 1, "IndicatorCode": "M"},
        {"SpatialDim": "NG", "TimeDim": 2020, "NumericValue": 1, "IndicatorCode": "M"},
        {"SpatialDim": "GHA", "TimeDim": "2019", "NumericValue": None, "IndicatorCode": "M"},
        {"SpatialDim": "KEN", "TimeDim": 2018, "NumericValue": "n/a", "IndicatorCode": "M"},
    ]
    df = bodies(spark, json.dumps({"value": records}), '{"value": []}', "not json", "[1]", "{}")
    got = sorted((r.country_code, r.year, r.value) for r in docs.parse_gho(df).collect())
    assert got == [("GHA", 2019, None), ("KEN", 2018, None), ("NGA", 2020, 300.1)]
    bare = bodies(spark, json.dumps(records[:1]))
    assert docs.parse_gho(bare).count() == 0
    assert docs.parse_gho(bare, allow_list_root=True).count() == 1
    flags = [r.ok for r in df.select(docs.readable(F.col("body")).alias("ok")).collect()]
    assert flags == [True, True, False, True, True]


def test_world_bank(spark):
    def rec(code, date, value, cid="NG"):
        return {
            "countryiso3code": code, "date": date, "value": value,
            "country": {"id": cid, "value": "Nigeria"}, "indicator": {"id": "BEDS", "value": "Beds"},
        }

    records = [rec("NGA", "2020", 0.5), rec("", "2020", 1.0, "ABC"), rec("NGA", "", 2.0), rec("GHA", "2021", None),
               rec("KEN", "20x0", 1.0)]
    df = bodies(spark, json.dumps([{"page": 1}, records]), json.dumps(records[:1]), '[{"page":1}]')
    got = sorted((r.country_code, r.year, r.value) for r in docs.parse_world_bank(df).collect())
    assert got == [("GHA", 2021, None), ("NGA", 2020, 0.5), ("NGA", 2020, 0.5)]
    labelled = docs.parse_world_bank(df, ["doc"], labels=True, drop_null=True).where("doc = 0")
    assert sorted((r.country_code, r.country_name, r.value) for r in labelled.collect()) == [
        ("ABC", "Nigeria", 1.0), ("NGA", "Nigeria", 0.5)
    ]
    assert [json.loads(r.record)["date"] for r in docs.unreadable_years(df).collect()] == ["20x0"]


TITLES = [
    ("Cholera - Nigeria", "Cholera", "NGA"),
    ("Cholera – situation in Haiti", "Cholera", "HTI"),
    ("Ebola update 3 — Uganda", "Ebola", "UGA"),
    ("Measles in Kenya", "Measles in Kenya", "KEN"),
    ("Yellow fever - Tanzania", "Yellow fever", "TZA"),
    ("Ebola update 3", "Ebola", None),
    ("Mpox - Guinea-Bissau", "Mpox", "GIN"),
    ("Plague - week 3 - Madagascar - 2017", "Plague", "MDG"),
    ("Avian flu - Iran", "Avian flu", "IRN"),
    ("Cases of cholera", None, None),
    ("", None, None),
    (None, None, None),
]


def test_titles(spark):
    df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(TITLES)], "i int, title string")
    df = df.withColumn("title", text.or_null(F.col("title")))
    found = with_country(df, "title", text.country_candidates(F.col("title")), default_countries(spark), "c")
    rows = found.select("i", text.disease_from_title(F.col("title")).alias("disease"), "c").orderBy("i").collect()
    assert [(r.disease, r.c.alpha_3 if r.c else None) for r in rows] == [t[1:] for t in TITLES]
    assert rows[4].c.name == "Tanzania, United Republic of" and rows[4].c.alpha_2 == "TZ"


def test_names_of_the_default_dimension(spark):
    names = {
        "Bosnia and Herzegovina": "BIH", "Trinidad and Tobago": "TTO", "Antigua and Barbuda": "ATG",
        "Saint Lucia": "LCA", "Saint Kitts and Nevis": "KNA", "Saint Vincent and the Grenadines": "VCT",
        "Sao Tome and Principe": "STP", "Virgin Islands, U.S.": "VIR", "ivory coast": "CIV",
    }
    df = spark.createDataFrame([(f"Cholera - {name}",) for name in names], "title string")
    candidates = text.country_candidates(F.col("title"))
    rows = with_country(df, "title", candidates, default_countries(spark), "c").collect()
    assert {r.title.split(" - ")[1]: r.c.alpha_3 for r in rows if r.c} == names


def test_outbreaks(spark):
    records = [
        {"Id": "x", "DonId": "y", "Title": "Cholera - Nigeria", "Summary": "<p>a &amp; b</p>", "Overview": None,
         "PublicationDate": "2024-05-01T10:00:00Z", "ItemDefaultUrl": "/x"},
        {"Id": "", "DonId": "z", "Title": "None", "Summary": "<p>a</p><script>if (1 < 2) x</script> c&lt;d",
         "PublicationDate": "2024-05-01T23:00:00-02:00"},
        {"Id": "w", "Title": "t", "PublicationDate": "soon"},
        {"Id": "v", "Title": "t", "PublicationDate": None},
    ]
    df = bodies(spark, json.dumps({"value": records}))
    got = docs.parse_outbreaks(df, default_countries(spark)).orderBy("outbreak_id").collect()
    assert [r.outbreak_id for r in got] == ["x", "z"]
    assert (got[0].summary, got[0].overview, got[0].country_iso3, got[0].year) == ("a & b", None, "NGA", 2024)
    assert got[1].publication_date.day == 2
    assert got[1].summary == "a if (1 < 2) x  c<d"


def test_notice_export_keys_are_stable(spark):
    records = [
        {"SystemSourceKey": "s", "Id": "i", "Title": "t", "regionscountries": ["g1", "g2"], "healthtopics": "h"},
        {"MetaTitle": "m", "Summary": "q", "Countries": ["c1"], "Diseases": "d"},
    ]
    df = bodies(spark, json.dumps({"value": records}))
    first, again = (sorted(map(tuple, docs.normalise_notices(df).collect())) for _ in range(2))
    assert first == again
    by_title = {r[1]: r for r in first}
    assert by_title["t"][0] == "s" and by_title["t"][4:] == ("g1", "h")
    assert len(by_title["m"][0]) == 64 and by_title["m"][4:] == ("c1", "d")


def test_html_to_text(spark):
    cases = {
        "plain  text": "plain  text",
        " a & b ": "a & b",
        "<p>x</p>y": "x y",
        "&lt;b&gt;": "<b>",
        "<!-- c > d -->z<br/>w": "z w",
        "": None,
        "<a href='x>y' title=\"<q>\">l</a> m": "l  m",
        "<script>if (a<b) f('<p>')</script><p>t</p>": "if (a<b) f('<p>') t",
        "caf&eacute; &#8211; &amp;amp;": "café – &",
        "<!DOCTYPE html><?xml v?><b>one</b><i>two</i>": "one two",
        "1 < 2": "1 < 2",
        "<div>done</div><span unfinished": "done",
    }
    rows = [*enumerate(cases), (len(cases), None)]
    df = spark.createDataFrame(rows, "i int, s string")
    got = [r.t for r in df.select("i", text.html_to_text("s").alias("t")).orderBy("i").collect()]
    assert got == [*cases.values(), None]


def test_keys(spark):
    keys = ["raw/cholera/20250101T000000Z-abc123.json", "raw/who_outbreaks/x.json", "raw/other/y.json",
            "raw/wb_cholera_life_expectancy/z.json"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    rows = df.select(
        raw.dataset_of(F.col("k")).alias("d"), raw.landed_at(F.col("k")).alias("at"), raw.landing_id(F.col("k")).alias("id")
    ).collect()
    assert [r.d for r in rows] == ["cholera", "who_outbreaks", None, "life_expectancy"]
    assert rows[0].id == "abc123" and rows[0].at.year == 2025 and rows[1].at is None


def test_numbers_and_dates(spark):
    df = spark.createDataFrame([(" 1.5e2 ",), ("1d",), ("abc",), ("-inf",), (None,), ("12",)], "t string")
    got = [r.n for r in df.select(numbers.to_number(F.col("t")).alias("n")).collect()]
    assert got == [150.0, None, None, float("-inf"), None, 12.0]
    texts = ["2020-01-02", "06/20/2021", "25/12/2021", "2021-99-99", "20200102", "Mar 4 2021", "2021-01-01T10:00:00Z", "soon"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    read = [r.d is not None for r in df.select(dates.parse_date_text(F.col("t")).alias("d")).collect()]
    assert read == [True, True, True, False, True, True, True, False]
    row = spark.range(1).select(
        compat.date_add("month", -1, F.lit("2020-03-31").cast("timestamp_ntz")).alias("m"),
        compat.date_diff("day", F.lit("2020-01-01").cast("timestamp_ntz"), F.lit("2020-03-01").cast("timestamp_ntz")).alias("n"),
    ).first()
    assert (row.m.month, row.m.day, row.n) == (2, 29, 60)


def facts(spark, rows):
    return spark.createDataFrame(rows, "country_code string, year int, indicator_code string, value double")


def test_latest_keeps_ties_and_null(spark):
    df = facts(spark, [("A", 2001, "x", 1.0), ("A", 2002, "x", None), ("B", 2002, "x", 3.0), ("B", 2002, "x", 4.0),
                       ("B", 2001, "x", 9.0), (None, 2005, "x", 7.0), ("C", 2000, "y", 1.0)])
    got = [(r.country_code, r.year, r.value) for r in ind.latest_per_country(df, "x").collect()]
    assert got == [("B", 2002, 4.0), ("B", 2002, 3.0), ("A", 2002, None)]
    assert sorted(map(tuple, shape.latest_value_per_key(df.where("indicator_code = 'x'"), "country_code").collect())) == [
        ("A", 2001, 1.0), ("B", 2002, 3.0)
    ]


def test_change_and_lag(spark):
    df = facts(spark, [("A", 2000, "x", 0.0), ("A", 2001, "x", 5.0), ("A", 2001, "x", 5.0), ("A", 2003, "x", 6.0), ("B", 2001, "x", 1.0)])
    got = {(r.year, r.value_prev, r.pct_change) for r in ind.yoy_percent(df, "x", "A").collect()}
    assert got == {(2000, None, None), (2001, 0.0, None), (2003, None, None)}
    steps = sorted((r.year, r.yoy_change if r.yoy_change is not None else -1) for r in ind.yoy_difference(df, "x", "A").collect())
    assert steps == [(2000, -1), (2001, 0.0), (2001, 5.0), (2003, 1.0)]
    pair = ind.change_between_years(df, "x", 2000, 2001).collect()
    assert {(r.country_code, r.value_start, r.pct_change) for r in pair} == {("A", 0.0, None), ("B", None, None)}


def test_dashboards(spark):
    rows = [(c, y, "x", float(i + y - 2000)) for i, c in enumerate(["NGA", "GHA", "KEN", "USA", "FRA", "DEU", "ITA"]) for y in (2000, 2001, 2023)]
    df = facts(spark, rows)
    tables = {"life_expectancy": df, "malaria_incidence": df, "wb_physicians_per_1000": df}
    data = dash.load_all(tables)
    assert data["life_expectancy_ssa"].count() == 9
    assert {r.country_code for r in data["malaria_incidence_top_countries"].collect()} == {"KEN", "USA", "FRA", "DEU", "ITA"}
    views = dash.build_views(data)
    assert views["malaria_heatmap"].columns == ["country_code", "2000", "2001", "2023"]
    roles = views["nigeria_vs_ssa_life_expectancy"].groupBy("role").count().collect()
    assert {r["role"]: r["count"] for r in roles} == {"highlight": 2, "peer": 4, "reference": 2}
    with pytest.raises(ValueError, match="missing required columns"):
        dash.heat_table(df.drop("value"))
    assert shape.drop_aggregates(facts(spark, [("WLD", 1, "x", 1.0), (None, 1, "x", 1.0), ("A", 1, "x", 1.0)])).count() == 2


def test_gho_source_filters(spark):
    records = [
        {"SpatialDim": "NGA", "SpatialDimType": "COUNTRY", "TimeDim": 2016, "NumericValue": 1},
        {"SpatialDim": "AFR", "SpatialDimType": "REGION", "TimeDim": 2016, "NumericValue": 1},
        {"SpatialDim": "NGA", "SpatialDimType": "COUNTRY", "TimeDim": 2014, "NumericValue": 1},
    ]
    df = bodies(spark, json.dumps({"value": records}))
    assert docs.parse_gho(df).count() == 3
    assert docs.parse_gho(df, countries_only=True, from_year=2015).count() == 1


def test_lake_text_leaves_literals_alone():
    text = "SELECT arbitrary(x), 'arbitrary(x) array[1]', Date_Diff ( 'Days', a, b), array[1, 2], \"from_unixtime(\" , approx_distinct (y)"
    assert compat.lake_text(text) == (
        "SELECT any_value(x), 'arbitrary(x) array[1]', Date_Diff ( DAY, a, b), array(1, 2), \"from_unixtime(\" , approx_count_distinct (y)"
    )
    with pytest.raises(ValueError, match="unknown date unit"):
        compat.lake_text("date_add('fortnight', 1, x)")


def test_amounts_from_a_column(spark):
    df = spark.createDataFrame([(1, "2020-01-31"), (-2, "2020-03-31"), (None, "2020-03-31")], "n int, at string")
    at = F.col("at").cast("timestamp_ntz")
    got = df.select(compat.date_add("month", F.col("n"), at).cast("string").alias("t")).collect()
    assert [r.t for r in got] == ["2020-02-29 00:00:00", "2020-01-31 00:00:00", None]
    assert df.select(compat.date_add("day", 1, at).cast("date").cast("string").alias("t")).first().t == "2020-02-01"


def test_notices_with_and_without_dates(spark):
    dates = ["2024-02-03T04:05:06Z", "3 February 2024", "February 3, 2024", "Feb 3, 2024", "03.02.2024", "", None, "2024-02-03T04:05:06.1234567+02:00"]
    body = json.dumps({"value": [{"DonId": str(i), "Title": "t", "PublicationDate": d} for i, d in enumerate(dates)]})
    records = docs.notice_records(spark.createDataFrame([("k", body)], "raw_key string, body string"), ["raw_key"])
    good = {json.loads(r.record)["DonId"]: r.reason for r in docs.undated_notices(records, ["raw_key"]).collect()}
    assert good == {"4": "unreadable date", "5": "no date", "6": "no date"}
    dated = records.where("publication_date is not null")
    assert dated.count() + len(good) == len(dates)
    assert {r.d for r in dated.select(F.col("publication_date").cast("date").cast("string").alias("d")).collect()} == {"2024-02-03"}


def test_official_country_names(spark):
    wanted = {
        "Federal Republic of Nigeria": "NGA", "Republic of Kenya": "KEN", "Democratic Republic of the Congo": "COD",
        "Republic of the Congo": "COG", "United States of America": "USA", "Czech Republic": "CZE", "Republic of Korea": "KOR",
        "Democratic People's Republic of Korea": "PRK", "U.S. Virgin Islands": "VIR", "Islamic Republic of Iran": "IRN",
        "Kingdom of Spain": "ESP", "United Republic of Tanzania": "TZA", "Nigeria": "NGA", "State of emergency": None,
        "United Kingdom": "GBR", "Saint Lucia": "LCA", None: None,
    }
    df = spark.createDataFrame([(t,) for t in wanted] * 2, "title string")
    found = with_country(df, "title", F.array(F.lower("title")), default_countries(spark), "country")
    rows = found.select("title", "country.alpha_3").collect()
    assert len(rows) == 2 * len(wanted) and {r.title: r.alpha_3 for r in rows} == wanted
