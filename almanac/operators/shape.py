"""Small frame helpers shared by the jobs: columns, ranges, unions, latest rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.dates import floor_day
from almanac.functions.numbers import to_number

# Codes of regions and world totals (fixed values).
AGGREGATE_CODES = ["WLD", "OWID", "AFR", "EUU", "ARB"]


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def require_columns(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing required columns: {missing}")
    return df


def enforce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Coerce the columns that exist to double, unreadable values to NULL."""
    present = {c: to_number(F.col(c)) for c in columns if c in df.columns}
    return df.withColumns(present) if present else df


def clean_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Coerce the columns to double and drop rows in which one of them is NULL."""
    return enforce_numeric(df, columns).dropna(subset=columns)


def ensure_date(df: DataFrame, name: str = "date") -> DataFrame:
    """A day column from `name`, else from InvoiceDate, else NULL."""
    source = next((c for c in (name, "InvoiceDate") if c in df.columns), None)
    day = floor_day(F.col(source)) if source else F.lit(None).cast("timestamp_ntz")
    return df.withColumn("date", day)


def between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows within the range, both ends included; an open end is None."""
    if low is not None:
        df = df.where(F.col(column) >= F.lit(low))
    if high is not None:
        df = df.where(F.col(column) <= F.lit(high))
    return df


def drop_aggregates(
    df: DataFrame, column: str = "country_code", codes: list[str] | None = None
) -> DataFrame:
    """Drop regional totals; rows without a code stay."""
    if column not in df.columns:
        return df
    return df.where(~F.coalesce(F.col(column).isin(codes or AGGREGATE_CODES), F.lit(False)))


def latest_year(df: DataFrame, year: str = "year") -> DataFrame:
    """Rows of the newest year in the table."""
    if year not in df.columns:
        return df
    newest = df.agg(F.max(F.col(year).cast("int")).alias("newest"))
    return df.where(F.col(year) == newest.scalar())


def latest_per_key(df: DataFrame, key: str, year: str = "year") -> DataFrame:
    """Rows of each key's newest year; several rows of that year all stay.

    The newest years are found with a map-side aggregate and matched back by a semi join,
    so no key's rows are ever gathered in one task: the runtime broadcasts the small side
    if it measures small, and otherwise splits hot keys of the sort-merge join.
    """
    newest = df.groupBy(key).agg(F.max(year).alias(year))
    return df.join(newest, [key, year], "left_semi")


def latest_value_per_key(
    df: DataFrame, key: str, year: str = "year", value: str = "value"
) -> DataFrame:
    """One row per key: the newest non-null value, the smallest one if a year repeats.

    Both steps keep fixed-width buffers and so stay hash aggregates with a map-side combine.
    """
    per_year = df.where(F.col(value).isNotNull()).groupBy(key, year).agg(F.min(value).alias(value))
    return (
        per_year.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(value, year).alias(value), F.max(year).alias(year))
        .select(key, year, value)
    )


def last_values(df: DataFrame, key: str, year: str, columns: list[str]) -> DataFrame:
    """The newest non-null value of each column per key, the largest one if a year repeats."""
    per_year = (
        df.where(F.col(key).isNotNull())
        .groupBy(key, year)
        .agg(*[F.max(c).alias(c) for c in columns])
    )
    return per_year.groupBy(key).agg(
        F.max(year).alias(year),
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(year))).alias(c) for c in columns],
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def first_available(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows of the first source that has the key; the order of `frames` is the priority."""
    tagged = [
        df.withColumns({"source": F.lit(name), "_priority": F.lit(i)})
        for i, (name, df) in enumerate(frames.items())
    ]
    rows = union_all(tagged)
    best = rows.groupBy(key).agg(F.min("_priority").alias("_priority"))
    return rows.join(best, [key, "_priority"], "left_semi").drop("_priority")


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of a full order."""
    return df.orderBy(*order).limit(n)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal-width bins between the minimum and the maximum, empty bins included.

    The frame is read twice, once for its range: pass a stored one.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    span = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    low, high = span["lo"], span["hi"]
    width = F.when(high > low, (high - low) / bins).otherwise(F.lit(1.0 / bins))
    start = F.when(high > low, low).otherwise(low - 0.5)
    slot = F.least(F.floor((F.col("v") - start) / width), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    slots = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return slots.join(counts, "bin", "left").select(
        "bin",
        (start + F.col("bin") * width).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def pivot_mean(df: DataFrame, row: str, column: str, value: str, labels: list | None = None) -> DataFrame:
    """Mean per row and column, one output column per column value in ascending order.

    The column values become columns. Name them in `labels` to read the input once; else
    all values found are taken.
    """
    clean = clean_numeric(df, [value]).dropna(subset=[row, column])
    if labels is None:
        found = clean.select(F.col(column).cast("int").alias("label")).distinct()
        labels = sorted(r["label"] for r in found.collect())
    return clean.groupBy(row).pivot(column, labels).agg(F.avg(value))
