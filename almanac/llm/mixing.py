"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, its source's target
over its source's size. The expected copies are summed along the source, ordered by size and
id; one random offset per source is added, and a document is emitted once for each whole
number that its stretch of the sum crosses. In this order neighbours have like sizes, so
the words taken stay within about one long document of the target.

The order within a source is a range partitioning of all rows: a source with a third of all
rows covers many ranges, and one row per (range, source) carries the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm.common import quoted, stored, table, without, words
from almanac.operators.ordered import with_row_number
from almanac.session import shuffle_width

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
_LOCAL_BITS = 33
OUTPUTS = ("size", "source_size", "target", "copies", "taken")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """One row per source with its target, from rows of (source, source_size).

    Sources in code point order, null last, weigh `weights`, repeating, and share
    `share` times the sum of sizes. A target stops at `most` times its source's size; the
    excess is shared again by weight until none is above. Each round is one aggregate over
    the sources; only two sums come to the driver.
    """
    order = [F.col("source").asc_nulls_last()]
    ranked = with_row_number(sizes, order, "position")
    weight = F.element_at(F.lit(list(weights)), ((F.col("position") - 1) % len(weights) + 1).cast("int"))
    weighed = ranked.withColumn("weight", weight.cast("double")).withColumn(
        "ceiling", F.lit(most) * F.col("source_size")
    )
    level, stopped = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("ceiling") < F.lit(level) * F.col("weight")
        got = weighed.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, F.col("ceiling"))).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        if not got["open"] or got["n"] == stopped:
            break
        level, stopped = (share * got["all"] - (got["held"] or 0.0)) / got["open"], got["n"]
    target = F.least(F.col("ceiling"), F.lit(level or 0.0) * F.col("weight"))
    return weighed.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: str) -> Column:
    """A number from 0 to 1 that depends on the seed and the source only."""
    named = F.coalesce(F.concat(F.lit(f"{seed}:="), source), F.lit(f"{seed}:null"))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = "mix",
    with_text: bool = True,
) -> DataFrame:
    """`docs` with size, source_size, target, copies and taken (copies times size).

    A null text has size 0; null sources are one source, the last; documents without a
    word get copies like the others and take no words. Repeated rows and rows with equal or null ids count
    one by one. An empty table gives an empty table. Columns of `docs` with the names of the
    outputs are replaced. Without `with_text` the text is left out and never sorted.
    """
    spark = docs.sparkSession
    size = F.size(words(F.col("text"))).cast("long")
    sized = without(docs.withColumn("_mix_size", size), *OUTPUTS).withColumnRenamed("_mix_size", "size")
    sized = sized if with_text else sized.drop("text")
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id")]
    ranged = (
        sized.repartitionByRange(shuffle_width(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("_mix_seq", F.monotonically_increasing_id())
    )
    # the sampled range bounds may differ if read again, so the ranges are fixed first
    ranged = stored(ranged, "mix-ranges").withColumn("_mix_part", F.shiftright("_mix_seq", _LOCAL_BITS))
    runs = ranged.groupBy("source", "_mix_part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("_mix_seq").alias("first"), F.sum("size").alias("size")
    )
    # one row per range of a source
    before = Window.partitionBy("source").orderBy("_mix_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(runs, "mix-runs")
    targets = source_targets(runs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    starts = runs.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).select(
        F.col("source").alias("_s"), F.col("_mix_part").alias("_p"), "first", "before"
    )
    targets = targets.withColumnRenamed("source", "_t")
    starts = starts.join(targets, starts["_s"].eqNullSafe(targets["_t"])).drop("_t")
    starts = stored(starts, "mix-starts")  # a known size lets the planner send it to the rows
    joined = ranged.join(
        starts, ranged["source"].eqNullSafe(starts["_s"]) & (ranged["_mix_part"] == starts["_p"])
    )
    rank = F.col("before") + F.col("_mix_seq") - F.col("first")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shift = offset(F.col("source"), seed)
    copies = (F.floor(expected * (rank + 1) + shift) - F.floor(expected * rank + shift)).cast("long")
    own = [quoted(c) for c in sized.columns]
    return joined.select(*own, "source_size", "target", copies.alias("copies")).withColumn(
        "taken", F.col("copies") * F.col("size")
    )


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs, with_text=False).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op5_source_mixing": op5_source_mixing}

ORACLE = {
    "op5_source_mixing": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, 2 * source_size AS cap,
         CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight
  FROM s
), r(round, level) AS (
  SELECT 0, 1.5 * sum(source_size) / sum(weight) FROM w
  UNION ALL
  SELECT round + 1,
         (SELECT (1.5 * sum(source_size) - coalesce(sum(cap) FILTER (cap < level * weight), 0))
                 / sum(weight) FILTER (NOT cap < level * weight) FROM w)
  FROM r WHERE round < 60
), t AS (
  SELECT source, source_size,
         least(cap, (SELECT level FROM r WHERE round = 60) * weight) AS target
  FROM w
), n AS (
  SELECT d.doc_id, d.source, d.size, CAST(t.source_size AS BIGINT) AS source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS e,
         CAST(('0x' || substr(md5(coalesce('mix:=' || d.source, 'mix:null')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS rank
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((floor(e * (rank + 1) + u) - floor(e * rank + u)) * size AS BIGINT) AS taken
FROM n
""",
}
