"""Whole-table profiles: nulls, distinct keys, date parsing, describe, spikes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.operators.ordered import exact_quantiles

SPIKE_METHODS = ("iqr", "zscore", "percentile")


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and their percentage per column, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    return counts.unpivot(["_rows"], df.columns, "column", "nulls").select(
        "column",
        "nulls",
        (F.try_divide(F.col("nulls"), F.col("_rows")) * 100).alias("pct_null"),
    )


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null values of each column that exists.

    The columns are stacked to (column, value) and grouped first, so one shuffle of
    combined values serves all columns.
    """
    present = [c for c in columns if c in df.columns]
    long = df.select(*[F.col(c).cast("string").alias(c) for c in present]).unpivot(
        [], present, "column", "value"
    )
    return (
        long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("column").agg(F.count("value").alias("n_distinct"))
    )


def date_parse_check(df: DataFrame, column: str, formats: dict[str, str]) -> DataFrame:
    """Unread values and their share for each named format."""
    text = F.trim(F.col(column))
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.count_if(F.try_to_timestamp(text, F.lit(f)).isNull()).alias(name)
            for name, f in formats.items()
        ],
    )
    return counts.unpivot(["_rows"], list(formats), "format", "failures").select(
        "format",
        "failures",
        F.try_divide(F.col("failures"), F.col("_rows")).alias("failure_share"),
    )


def missing_share(df: DataFrame, column: str) -> DataFrame:
    """One row: present and missing values of a column and the missing share."""
    missing = F.count_if(F.col(column).isNull())
    return df.agg(
        F.count(column).alias("non_null"),
        missing.alias("missing"),
        F.try_divide(missing, F.count(F.lit(1))).alias("missing_share"),
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    long = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .where("value is not null")
    )
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = (
        exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        .groupBy("column")
        .pivot("point", [0.25, 0.5, 0.75])
        .agg(F.first("value"))
        .toDF("column", "q25", "q50", "q75")
    )
    return moments.join(quartiles, "column").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def flag_spikes(
    daily: DataFrame,
    method: str = "iqr",
    value: str = "transactions",
    iqr_multiplier: float = 1.5,
    z_limit: float = 3.0,
    quantile: float = 0.95,
) -> DataFrame:
    """Score and flag unusually high days.

    `daily` has one row per calendar day, so the exact percentile's value table is bounded.
    It is read twice, once for its distribution: pass a stored frame.
    """
    if method not in SPIKE_METHODS:
        raise ValueError(f"method must be one of {SPIKE_METHODS}")
    v = F.col(value).cast("double")
    if method == "zscore":
        stats = daily.agg(F.struct(F.avg(v).alias("mean"), F.stddev_pop(v).alias("sd")))
        score = F.try_divide(v - F.col("_stats.mean"), F.col("_stats.sd"))
        scored = daily.withColumn("_stats", stats.scalar()).withColumn(
            "spike_score", F.coalesce(score, F.lit(0.0))
        )
        return scored.withColumn("is_spike", F.col("spike_score") > z_limit).drop("_stats")
    if method == "iqr":
        q1, q3 = F.percentile(v, 0.25), F.percentile(v, 0.75)
        limit = daily.agg((q3 + F.lit(iqr_multiplier) * (q3 - q1)).alias("limit"))
    else:
        limit = daily.agg(F.percentile(v, quantile).alias("limit"))
    return (
        daily.withColumn("_limit", limit.scalar())
        .withColumns(
            {
                "spike_score": (v - F.col("_limit")) / (F.col("_limit") + 1e-9),
                "is_spike": v > F.col("_limit"),
            }
        )
        .drop("_limit")
    )


def spikes(daily: DataFrame, method: str = "iqr", value: str = "transactions", **limits) -> DataFrame:
    """Only the flagged days, highest first."""
    flagged = flag_spikes(daily, method, value, **limits).where("is_spike")
    return flagged.orderBy(F.col(value).desc_nulls_last(), F.col("date").asc())


def daily_sketches(df: DataFrame, column: str, at: str, size: int = 14) -> DataFrame:
    """A mergeable sketch of the distinct values of each day; 2 ** size registers at most."""
    return df.groupBy(F.to_date(at).alias("day")).agg(F.hll_sketch_agg(column, size).alias("sketch"))


def distinct_over(sketches: DataFrame, ranges: DataFrame) -> DataFrame:
    """Distinct values of ranges of days (`range`, `first`, `last`) from daily sketches, without the rows.

    The standard error is about 1.04 / sqrt(2 ** size) of the count.
    """
    inside = sketches.join(F.broadcast(ranges), F.col("day").between(F.col("first"), F.col("last")))
    merged = inside.groupBy("range").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("range", F.hll_sketch_estimate("sketch").alias("distinct"))
