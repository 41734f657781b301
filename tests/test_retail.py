import datetime as dt
import random
import textwrap

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from almanac.operators import profiles, retail, rfm, shape

SCHEMA = (
    "InvoiceNo string, StockCode string, Description string, Quantity double, "
    "InvoiceDate timestamp_ntz, UnitPrice double, CustomerID double, _line_no bigint"
)


def random_lines(seed, n=300, customers=23):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        invoice = rng.choice(["", "", "C"]) + str(rng.randint(1, 60))
        code = rng.choice(["B", "POST", "85123A", "22752", "ABCDE", "D"] + [f"{k:05d}" for k in range(9)])
        rows.append(
            (
                rng.choice([invoice, invoice, invoice, None]),
                code,
                rng.choice(["Adjust bad debt", "lamp", "x" * 60, "y" * 61, None]),
                rng.choice([float(rng.randint(-5, 9)), None]),
                rng.choice([dt.datetime(2011, 1, 1) + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 40)), None]),
                rng.choice([round(rng.uniform(0, 9), 2), -4.0, 0.0]),
                rng.choice([float(rng.randint(1, customers)), None]),
                i,
            )
        )
    return rows


def both(spark, seed, **options):
    rows = random_lines(seed, **options)
    lines = retail.settle_adjustments(retail.canonical_lines(spark.createDataFrame(rows, SCHEMA)))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    pdf = pd.DataFrame(rows, columns=names)
    pdf["InvoiceDate"] = pd.to_datetime(pdf["InvoiceDate"])
    pdf["LineTotal"] = pdf.UnitPrice * pdf.Quantity
    pdf["canc"] = pdf.InvoiceNo.fillna("").str.upper().str.startswith("C")
    pdf["adj"] = (pdf.StockCode.str.upper() == "B") & pdf.Description.fillna("").str.upper().str.contains("ADJUST|BAD DEBT")
    pdf["op"] = ~pdf.canc & ~pdf.adj & pdf.LineTotal.notna()
    pdf["date"] = pdf.InvoiceDate.dt.floor("d")
    return lines, pdf


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_daily_kpis(spark, seed):
    lines, pdf = both(spark, seed)
    got = retail.daily_kpis(lines).orderBy("date").toPandas().set_index("date")
    op = pdf[pdf.op]
    want = pd.DataFrame(
        {
            "tx_all": pdf.groupby("date").size(),
            "transactions": op.groupby("date")["InvoiceNo"].nunique(),
            "operational_revenue": op.groupby("date")["LineTotal"].sum(),
            "cancellations": pdf[pdf.canc].groupby("date").size(),
            "aov": op.groupby(["date", "InvoiceNo"])["LineTotal"].sum().groupby("date").mean(),
        }
    ).fillna(0)
    assert list(got.index) == list(want.index)
    for c in want.columns:
        assert np.allclose(got[c].astype(float), want[c]), c


@pytest.mark.parametrize("seed", [1, 2])
def test_product_summary(spark, seed):
    lines, pdf = both(spark, seed)
    got = retail.product_summary(lines, line_order="_line_no").toPandas().set_index("StockCode").sort_index()
    op = pdf[pdf.op]
    group = op.groupby("StockCode")
    want_revenue, want_qty = group["LineTotal"].sum(), group["Quantity"].sum()
    assert np.allclose(got.revenue, want_revenue)
    assert np.allclose(got.qty, want_qty)
    assert list(got.tx_lines) == list(group["InvoiceNo"].count())
    assert list(got.distinct_customers) == list(group["CustomerID"].nunique())
    first = group["Description"].agg(lambda s: next(iter(s.dropna()), ""))
    assert list(got.description) == list(first)
    assert np.allclose(got.rev_share, want_revenue / want_revenue.sum())
    assert set(got.desc_short[got.description == "y" * 61]) <= {"y" * 57 + "..."}
    assert set(got.desc_short[got.description == "x" * 60]) <= {"x" * 60}
    assert got.loc["POST"].is_meta and got.loc["ABCDE"].is_meta and not got.loc["85123A"].is_meta


@pytest.mark.parametrize("seed,customers", [(1, 23), (2, 5), (3, 9), (4, 2)])
def test_rfm_matches_quartile_cut(spark, seed, customers):
    lines, pdf = both(spark, seed, customers=customers)
    got = rfm.rfm_scores(lines).toPandas().sort_values("CustomerID").reset_index(drop=True)
    oper = pdf[~pdf.canc & ~pdf.adj]
    at = oper.InvoiceDate.max() + pd.Timedelta(days=1)
    want = oper.groupby("CustomerID").agg(
        last=("InvoiceDate", "max"), frequency=("InvoiceNo", "nunique"), monetary=("LineTotal", "sum")
    ).reset_index()
    want["recency_days"] = (at - want["last"]).dt.days.fillna(np.inf)
    assert list(got.CustomerID) == list(want.CustomerID)
    assert list(got.recency_days) == list(want.recency_days)
    assert list(got.frequency) == list(want.frequency)
    assert np.allclose(got.monetary, want.monetary)
    # ranks by cutting positions at the quartiles, from the table Spark scored
    for metric, rank, labels in (
        ("recency_days", "R_rank", [4, 3, 2, 1]), ("frequency", "F_rank", [1, 2, 3, 4]),
        ("monetary", "M_rank", [1, 2, 3, 4]),
    ):
        cut = pd.qcut(got[metric].rank(method="first"), 4, labels=labels).astype(int)
        assert list(got[rank]) == list(cut), metric
    assert list(got.RFM_score) == list(got.R_rank * 100 + got.F_rank * 10 + got.M_rank)


@pytest.mark.parametrize(
    "n,buckets",
    [(5, [1, 1, 2, 3, 4]), (6, [1, 1, 2, 3, 4, 4]), (7, [1, 1, 2, 2, 3, 4, 4]),
     (9, [1, 1, 1, 2, 2, 3, 3, 4, 4]), (1, [2]), (0, [])],
)
def test_bucket_sizes(spark, n, buckets):
    rows = [(i, dt.datetime(2020, 1, 1), 1.0, i, float(i)) for i in range(n)]
    df = spark.createDataFrame(
        rows, "CustomerID int, last_tx timestamp_ntz, recency_days double, frequency int, monetary double"
    )
    scored = rfm.add_scores(df).orderBy("CustomerID").collect()
    assert [r.M_rank for r in scored] == buckets
    if n == 1:
        assert scored[0].RFM_score == 322


def test_segments_drop_meta_and_label(spark):
    lines, pdf = both(spark, 5)
    got = rfm.rfm_segments(lines).toPandas()
    assert set(got.segment) <= {"Champion", "Loyal", "At Risk", "Lost", "Other"}
    champions = got[(got.R_rank == 4) & (got.F_rank == 4) & (got.M_rank == 4)]
    assert set(champions.segment) <= {"Champion"}
    assert (got.recency_days >= 0).all()


def test_weekly_and_moving_average(spark):
    days = pd.date_range("2011-01-01", "2011-03-01", freq="D").delete(range(10, 30))
    values = np.arange(len(days), dtype=float)
    df = spark.createDataFrame(
        [(d.to_pydatetime(), float(v)) for d, v in zip(days, values)], "date timestamp_ntz, v double"
    )
    weekly = retail.weekly_totals(df, "v", "w").orderBy("date").toPandas()
    want = pd.Series(values, index=days).resample("W").sum()
    assert list(weekly.date) == list(want.index) and np.allclose(weekly.w, want.values)
    moved = retail.moving_average(df, "v", "m").orderBy("date").toPandas()
    assert np.allclose(moved.m, pd.Series(values).rolling(7, min_periods=1).mean())


@pytest.mark.parametrize("method", ["iqr", "zscore", "percentile"])
def test_spikes(spark, method):
    rng = random.Random(4)
    counts = [rng.randint(90, 110) for _ in range(60)] + [400, 500]
    rows = [(dt.datetime(2011, 1, 1) + dt.timedelta(days=i), c) for i, c in enumerate(counts)]
    daily = spark.createDataFrame(rows, "date timestamp_ntz, transactions int")
    got = profiles.flag_spikes(daily, method).orderBy("date").toPandas()
    s = pd.Series(counts, dtype=float)
    if method == "iqr":
        q1, q3 = np.percentile(s, [25, 75])
        limit = q3 + 1.5 * (q3 - q1)
    else:
        limit = np.quantile(s, 0.95)
    score = (s - s.mean()) / s.std(ddof=0) if method == "zscore" else (s - limit) / (limit + 1e-9)
    assert np.allclose(got.spike_score, score)
    assert list(got.is_spike) == list(score > 3 if method == "zscore" else s > limit)


def test_dates_take_one_format_per_column(spark):
    rows = [("12/13/2010 9:02",), ("1/2/2011 10:00",), ("bad",), (None,)]
    lines = retail.canonical_lines(spark.createDataFrame(rows, "InvoiceDate string"))
    got = [r.InvoiceDate for r in lines.collect()]
    assert got == [dt.datetime(2010, 12, 13, 9, 2), dt.datetime(2011, 1, 2, 10, 0), None, None]
    assert "InvoiceDate_parsed_mf" in lines.columns
    day_first = retail.parse_invoice_date(spark.createDataFrame(rows[:2], "InvoiceDate string"), day_first=True)
    assert [r.InvoiceDate for r in day_first.collect()] == got[:2]
    assert day_first.where("InvoiceDate_parsed is null").count() == 1


def test_each_date_text_is_tried_once(spark):
    rows = [("1/2/2011 10:00",)] * 3 + [(" 1/2/2011 10:00",), ("bad",), ("bad",), (None,)]
    unread = retail._unread(spark.createDataFrame(rows, "at string"), "at", ["M/d/yyyy H:mm", "yyyy-MM-dd"])
    assert unread.first().asDict() == {"rows": 7, "0": 3, "1": 7}
    # texts are grouped below the aggregate that parses them
    plan = unread._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and "gettimestamp" in plan.split("Aggregate")[1]
    assert "gettimestamp" not in plan.split("Aggregate")[2]
    empty = retail._unread(spark.createDataFrame([], "at string"), "at", ["yyyy-MM-dd"])
    assert empty.first().asDict() == {"rows": 0, "0": 0}


def test_coercion_and_flags_on_text(spark):
    rows = [("c1", "b", "ADJUST x", "abc", "2"), (None, "22752", None, "3", "1.5"), ("5", "B", "Bad Debt", "1", "-1")]
    df = spark.createDataFrame(rows, "` InvoiceNo` string, StockCode string, Description string, Quantity string, UnitPrice string")
    got = retail.canonical_lines(df).collect()
    assert [r.Quantity for r in got] == [None, 3.0, 1.0]
    assert [r.LineTotal for r in got] == [None, 4.5, -1.0]
    assert [r.is_cancellation for r in got] == [True, False, False]
    assert [r.is_adjustment for r in got] == [True, False, True]
    assert [r.negative_revenue for r in got] == [False, False, True]
    assert [r.is_operational for r in got] == [False, True, False]


def test_word_cut_matches_the_standard_library(spark):
    texts = [
        "short", "WHITE HANGING HEART T-LIGHT HOLDER " * 3, "a" * 80, "one two  three\tfour " * 6,
        "well-known self-made hand-crafted wood-block alphabet-soup long-tail price-list", "", "x " * 40,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.s for r in df.select(retail.shorten_words(F.col("t")).alias("s")).collect()]
    assert got == [textwrap.shorten(t, width=60, placeholder="...") for t in texts]


def test_missing_days_histogram_and_describe(spark):
    days = [dt.datetime(2011, 1, d) for d in (1, 2, 5)]
    df = spark.createDataFrame([(d, float(i)) for i, d in enumerate(days)], "date timestamp_ntz, v double")
    assert [r.date.day for r in retail.missing_days(df).orderBy("date").collect()] == [3, 4]
    rng = random.Random(9)
    values = [rng.gauss(0, 1) for _ in range(200)]
    numbers = spark.createDataFrame([(v,) for v in values], "v double")
    bins = shape.histogram(numbers, "v", 12).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=12)
    assert [b.n for b in bins] == list(counts)
    assert np.allclose([b.bin_start for b in bins], edges[:-1])
    row = profiles.describe(numbers, ["v"]).first()
    want = pd.Series(values).describe()
    assert np.allclose(list(row)[1:], [want[k] for k in ("count", "mean", "std", "min", "25%", "50%", "75%", "max")])


def test_headline_keys_and_errors(spark):
    lines, pdf = both(spark, 8)
    with pytest.raises(ValueError, match="InvoiceDate"):
        retail.daily_kpis(lines.drop("InvoiceDate"))
    with pytest.raises(ValueError, match="product column"):
        retail.product_key(lines.drop("StockCode"))
    products = retail.product_summary(lines, line_order="_line_no")
    best = retail.pareto(products, "StockCode", 5).orderBy(F.desc("revenue")).toPandas()
    assert best.cum_share.iloc[-1] == pytest.approx(1.0)
    only_meta = products.where("is_meta")
    assert retail.without_meta(only_meta).count() == only_meta.count()
    assert not any(r.is_meta for r in retail.without_meta(products).collect())


def test_explicit_cancellations(spark):
    df = spark.createDataFrame([("2", "yes"), ("1", None), ("1", "no")], "InvoiceNo string, Cancelled string")
    assert [tuple(r) for r in retail.explicit_cancellations(df).collect()] == [("1", "no"), ("2", "yes")]
    assert retail.explicit_cancellations(df.drop("Cancelled")).count() == 0
