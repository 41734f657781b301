"""Customer recency, frequency and monetary scores."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.operators.ordered import exact_quantiles, with_row_number
from almanac.operators.retail import is_meta_key
from almanac.operators.shape import require_columns
from almanac.session import checkpointed

METRICS = ["frequency", "monetary", "recency_days"]
BUCKETS = 4


def _moment(at: dt.datetime | None) -> Column:
    """The wall-clock time as a literal that no time zone setting can shift."""
    return F.lit(at.isoformat(" ") if at else None).cast("timestamp_ntz")


def _customer_figures(lines: DataFrame) -> DataFrame:
    """Last date, invoices and revenue per customer; anonymous lines form the NULL row.

    The invoice number of anonymous lines is blanked, so the quarter of all lines without
    a customer collapses on the map side and still carries its newest date.
    """
    known = F.col("CustomerID").isNotNull()
    return lines.groupBy("CustomerID").agg(
        F.max("InvoiceDate").alias("last_tx"),
        F.min("InvoiceDate").alias("_first_tx"),
        F.count_distinct(F.when(known, F.col("InvoiceNo"))).alias("frequency"),
        F.sum("LineTotal").cast("double").alias("monetary"),
    )


def _cut_points(customers: DataFrame, rows: int) -> dict[str, list[tuple[float, object]]]:
    """For each metric the (value, customer) at the last position of buckets 1, 2 and 3.

    The bucket of position r among n is max(1, ceil(4 (r - 1) / (n - 1))), so bucket k ends
    at position k (n - 1) / 4 + 1. All metrics are sorted in one range shuffle with the
    customer as tie-breaker; nine rows come back, whatever the number of customers.
    """
    long = customers.select(
        "CustomerID", *[F.col(m).cast("double").alias(m) for m in METRICS]
    ).unpivot(["CustomerID"], METRICS, "metric", "value")
    order = [F.col("metric"), F.col("value"), F.col("CustomerID")]
    numbered = with_row_number(long, order, "position")
    # with few customers several buckets end at the same position
    ends: dict[int, list[str]] = {}
    for i, metric in enumerate(sorted(METRICS)):
        for k in range(1, BUCKETS):
            ends.setdefault(i * rows + k * (rows - 1) // BUCKETS + 1, []).append(metric)
    cuts: dict[str, list[tuple]] = {m: [] for m in METRICS}
    for row in numbered.where(F.col("position").isin(list(ends))).collect():
        for metric in ends[row["position"]]:
            cuts[metric].append((row["value"], row["CustomerID"]))
    return cuts


def _bucket(metric: str, cuts: list[tuple[float, object]]) -> Column:
    value, customer = F.col(metric).cast("double"), F.col("CustomerID")
    bucket = F.lit(1)
    for cut_value, cut_customer in cuts:
        after = (value > F.lit(cut_value)) | (
            (value == F.lit(cut_value)) & (customer > F.lit(cut_customer))
        )
        bucket = bucket + after.cast("int")
    return bucket


def add_scores(customers: DataFrame, stored: bool = False) -> DataFrame:
    """Quartile ranks of the three metrics (newest is best) and the combined score.

    The customers are read three times; `stored` says they come from storage already.
    """
    fixed = customers if stored else checkpointed(customers)
    rows = fixed.count()
    if rows == 0:
        ranks = {r: F.lit(0) for r in ("R_rank", "F_rank", "M_rank")}
    elif rows == 1:
        # a single customer has no quartiles; equal-width bins put it here
        ranks = {"R_rank": F.lit(3), "F_rank": F.lit(2), "M_rank": F.lit(2)}
    else:
        cuts = _cut_points(fixed, rows)
        ranks = {
            "R_rank": F.lit(BUCKETS + 1) - _bucket("recency_days", cuts["recency_days"]),
            "F_rank": _bucket("frequency", cuts["frequency"]),
            "M_rank": _bucket("monetary", cuts["monetary"]),
        }
    return fixed.withColumns(ranks).withColumn(
        "RFM_score", F.col("R_rank") * 100 + F.col("F_rank") * 10 + F.col("M_rank")
    )


def rfm_scores(df: DataFrame, snapshot: dt.datetime | None = None) -> DataFrame:
    """Scores of all known customers over uncancelled, unadjusted lines.

    The snapshot is the newest of those lines plus one day unless given.
    """
    require_columns(df, ["CustomerID", "InvoiceNo", "InvoiceDate", "LineTotal"], "rfm")
    figures = _customer_figures(df.where(~F.col("is_cancellation") & ~F.col("is_adjustment")))
    figures = checkpointed(figures)
    if snapshot is None:
        newest = figures.agg(F.max("last_tx").alias("newest")).first()["newest"]
        snapshot = newest + dt.timedelta(days=1) if newest is not None else None
    at = _moment(snapshot)
    seconds = F.timestamp_diff("SECOND", F.col("last_tx").cast("timestamp_ntz"), at)
    customers = figures.where("CustomerID is not null").select(
        "CustomerID",
        "last_tx",
        F.coalesce(F.floor(seconds / 86400).cast("double"), F.lit(float("inf"))).alias("recency_days"),
        F.col("frequency").cast("bigint").alias("frequency"),
        F.coalesce("monetary", F.lit(0.0)).alias("monetary"),
    )
    return add_scores(customers, stored=True)


def rfm_segments(df: DataFrame) -> DataFrame:
    """The segment variant: product lines only, snapshot at midnight, whole-day recency.

    Cancelled lines are left out, adjustments are not. A customer without a date gets the
    age of the first line plus 30 days.
    """
    lines = df.where(~F.col("is_cancellation"))
    meta = F.col("is_meta") if "is_meta" in df.columns else is_meta_key("StockCode")
    figures = checkpointed(_customer_figures(lines.where(~meta)))
    if figures.isEmpty():  # nothing but meta codes: score all lines
        figures = checkpointed(_customer_figures(lines))
    span = figures.agg(F.max("last_tx").alias("hi"), F.min("_first_tx").alias("lo")).first()
    day = dt.timedelta(days=1)
    midnight = dict(hour=0, minute=0, second=0, microsecond=0)
    snapshot = (span["hi"] + day).replace(**midnight) if span["hi"] else None
    oldest = (snapshot - span["lo"]).days + 30 if snapshot else None
    at = _moment(snapshot)
    seconds = F.timestamp_diff("SECOND", F.col("last_tx").cast("timestamp_ntz"), at)
    recency = F.coalesce(F.floor(seconds / 86400).cast("int"), F.lit(oldest).cast("int"))
    customers = (
        figures.where("CustomerID is not null")
        .where(~(F.col("monetary").isNull() & (F.col("frequency") == 0)))
        .select(
            "CustomerID",
            "last_tx",
            F.greatest(recency, F.lit(0)).alias("recency_days"),
            F.col("frequency").cast("int").alias("frequency"),
            F.coalesce("monetary", F.lit(0.0)).alias("monetary"),
        )
    )
    return add_scores(customers, stored=True).withColumn("segment", segment())


def segment() -> Column:
    """Customer segment from the three ranks; the first matching rule wins."""
    r, f, m = F.col("R_rank"), F.col("F_rank"), F.col("M_rank")
    return (
        F.when((r == 4) & (f == 4) & (m == 4), "Champion")
        .when((r >= 3) & (f >= 3) & (m >= 3), "Loyal")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r == 1) & (f == 1), "Lost")
        .otherwise("Other")
    )


def score_counts(scores: DataFrame) -> DataFrame:
    return scores.groupBy("RFM_score").agg(F.count(F.lit(1)).alias("customers"))


def top_customers(scores: DataFrame, n: int = 20) -> DataFrame:
    return (
        scores.select("CustomerID", "monetary", "frequency", "recency_days")
        .orderBy(F.col("monetary").desc_nulls_last(), F.col("CustomerID").asc())
        .limit(n)
    )


def clipped(scores: DataFrame, days: int = 365, quantile: float = 0.99) -> DataFrame:
    """Recency cut at `days`, frequency and monetary cut at their quantile."""
    limits = {
        row["column"]: row["value"]
        for row in exact_quantiles(scores, ["frequency", "monetary"], [quantile]).collect()
    }
    return scores.withColumns(
        {
            "recency_clip": F.least(F.col("recency_days").cast("double"), F.lit(float(days))),
            "frequency_clip": F.least(F.col("frequency").cast("double"), F.lit(limits.get("frequency"))),
            "monetary_clip": F.least(F.col("monetary"), F.lit(limits.get("monetary"))),
        }
    )
