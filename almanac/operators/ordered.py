"""Row numbers, running totals and previous values over a whole table.

A window without PARTITION BY moves every row into one task. Here the rows are
range-partitioned by the order columns instead; each partition is numbered on its own and
the partition sizes (one row per partition) give the offsets. The range bounds are
sampled, so the partitioned frame is checkpointed before it is read twice.

Order columns should identify a row, or hot values should be grouped first: rows that are
equal in all of them land in the same range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.session import checkpointed, shuffle_width

PART, SEQ = "_part", "_seq"
_LOCAL_BITS = 33


def _ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    width = shuffle_width(df.sparkSession)
    ranged = df.repartitionByRange(width, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn(SEQ, F.monotonically_increasing_id())
    return checkpointed(ranged.withColumn(PART, F.shiftright(SEQ, _LOCAL_BITS)))


def _before() -> Window:
    # one row per range partition, so this window is bounded by the shuffle width
    return Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def _with_offsets(ranged: DataFrame, offsets: DataFrame) -> DataFrame:
    # one row per range partition: always small enough to broadcast
    return ranged.join(F.broadcast(offsets), PART)


def with_row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the 1-based position of each row in the order given."""
    ranged = _ranged(df, order)
    sizes = ranged.groupBy(PART).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select(
        PART, F.coalesce(F.sum("_rows").over(_before()), F.lit(0)).alias("_offset")
    )
    local = F.col(SEQ).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        _with_offsets(ranged, offsets)
        .withColumn(name, F.col("_offset") + local + 1)
        .drop(PART, SEQ, "_offset")
    )


def with_running_total(df: DataFrame, order: list[Column], amount: str, name: str) -> DataFrame:
    """Add the sum of `amount` over this row and all rows before it."""
    ranged = _ranged(df, order)
    totals = ranged.groupBy(PART).agg(F.sum(amount).alias("_total"))
    offsets = totals.select(
        PART, F.coalesce(F.sum("_total").over(_before()), F.lit(0)).alias("_offset")
    )
    upto = Window.partitionBy(PART).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, 0)
    return (
        _with_offsets(ranged, offsets)
        .withColumn(name, F.col("_offset") + F.sum(amount).over(upto))
        .drop(PART, SEQ, "_offset")
    )


def with_previous(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Add the value of the row just before, NULL for the very first row."""
    ranged = _ranged(df, order)
    ends = ranged.groupBy(PART).agg(F.max_by(value, SEQ).alias("_end"))
    carried = ends.select(PART, F.lag("_end").over(Window.orderBy(PART)).alias("_carried"))
    within = Window.partitionBy(PART).orderBy(SEQ)
    first = F.row_number().over(within) == 1
    return (
        _with_offsets(ranged, carried)
        .withColumn(name, F.when(first, F.col("_carried")).otherwise(F.lag(value).over(within)))
        .drop(PART, SEQ, "_carried")
    )


def exact_quantiles(df: DataFrame, columns: list[str], points: list[float]) -> DataFrame:
    """Linearly interpolated quantiles of numeric columns, NULLs ignored.

    One row per (column, point). Equal values are counted first, so a hot value is one
    row; the running count over the sorted values then finds the two neighbours of each
    point. All columns share one shuffle.
    """
    long = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .where("value is not null")
    )
    counted = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    running = with_running_total(counted, [F.col("column"), F.col("value")], "_n", "_upto")
    ends = running.groupBy("column").agg(
        F.max("_upto").alias("_end"), F.sum("_n").alias("_rows")
    )
    targets = ends.select(
        "column", "_end", "_rows", F.explode(F.lit([float(p) for p in points])).alias("point")
    ).select(
        "column",
        "point",
        ((F.col("_rows") - 1) * F.col("point")).alias("_at"),
        (F.col("_end") - F.col("_rows")).alias("_start"),
    )
    # at most len(columns) * len(points) targets: a fixed, small frame
    joined = running.join(F.broadcast(targets), "column")
    position = F.col("_upto") - F.col("_start") - 1
    low, high = F.floor("_at"), F.ceil("_at")
    found = joined.groupBy("column", "point", "_at").agg(
        F.min(F.when(position >= low, F.col("value"))).alias("_low"),
        F.min(F.when(position >= high, F.col("value"))).alias("_high"),
    )
    value = F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_at") - F.floor("_at"))
    return found.select("column", "point", value.alias("value"))
