"""Merkle manifests of a dataset: leaves, roots and proofs, by fixed-width pieces of strings.

Eight consecutive nodes make one of the next level. A block of 512 consecutive nodes of a
group is one row that keeps each of its levels as one string of concatenated digests: a parent
is the digest of 512 bytes cut from the level below, and what stands before and after a node
within these 512 bytes are its siblings. The tops of the blocks are the nodes of the next
round, three levels up, until each group has one node; these nodes are then the leaves of one
last tree. On the way back each block is joined with its one parent, so a leaf gets its
whole path and no key has more rows than a block.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm.common import CRC32_SQL, crc32_mod, stored, table
from almanac.session import shuffle_width

RUN = 8
HEIGHT = 3
BLOCK = RUN**HEIGHT
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before:string,after:string>>"


def framed(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[framed(v) for v in values]), 256)


def proof_text(path: Column) -> Column:
    """All siblings on the way up, one after the other."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def _placed(nodes: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Add pos, the place of a row in its group `g` from 0, and n, the group's size; also the largest size.

    Rows are range-partitioned over all groups, so a large group spans many partitions. Rows
    equal in group and order are equal nodes, so it does not matter which comes first.
    """
    width = shuffle_width(nodes.sparkSession)
    sort = ["g", *order, "_tie"]
    tied = nodes.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(width, *sort).sortWithinPartitions(*sort).drop("_tie")
    ranged = ranged.withColumns({"_seq": F.monotonically_increasing_id(), "_part": F.spark_partition_id()})
    ranged = stored(ranged, "ranged")
    sizes = ranged.groupBy("_part", "g").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_size"))
    # a group has at most one row per partition here
    parts = Window.partitionBy("g")
    before = parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        sizes.select(
            "_part", "g", "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
            F.sum("_size").over(parts).alias("n"),
        ),
        "offsets",
    )
    largest = offsets.agg(F.max("n")).first()[0] or 0
    joined = ranged.join(offsets, ["_part", "g"])
    pos = F.col("_seq") - F.col("_first") + F.col("_before")
    return joined.withColumn("pos", pos).drop("_seq", "_part", "_first", "_before"), largest


def _parents(level: Column) -> Column:
    """The next level of a block, as one string: a digest of every 512 bytes."""
    width = RUN * DIGEST
    last = F.floor((F.octet_length(level) - 1) / width).cast("int")
    hashes = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.sha2(F.substring(level, i * width + 1, F.lit(width)), 256)
    )
    return F.array_join(hashes, "").cast("binary")


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per block: g, block, n, its nodes in order, the strings l0 to l2 of its levels, and its top."""
    own = F.struct(F.col("pos"), F.col("hash"), F.col("own"))
    levels = F.when(F.col("n") <= 1, 0).when(F.col("n") <= RUN, 1).when(F.col("n") <= RUN * RUN, 2).otherwise(HEIGHT)
    rows = (
        nodes.groupBy("g", F.floor(F.col("pos") / BLOCK).alias("block"))
        .agg(F.sort_array(F.collect_list(own)).alias("rows"), F.max("n").alias("n"))
        .withColumn("height", levels)
        .withColumn("l0", F.array_join(F.col("rows.hash"), "").cast("binary"))
        .withColumn("rows", F.transform("rows", lambda r: r["own"]))
    )
    for k in range(HEIGHT):
        rows = rows.withColumn(f"l{k + 1}", F.when(F.col("height") > k, _parents(F.col(f"l{k}"))))
    top = F.get(F.array(*[F.col(f"l{k}") for k in range(HEIGHT + 1)]), F.col("height")).cast("string")
    return rows.withColumn("top", top).drop(f"l{HEIGHT}")


def _segments(place: Column) -> Column:
    """The siblings of the node at `place` of its block, level by level."""

    def level(k: int) -> Column:
        at = F.floor(place / RUN**k).cast("int")
        inside = at % RUN
        before = F.substring(f"l{k}", (at - inside) * DIGEST + 1, inside * DIGEST)
        after = F.substring(f"l{k}", (at + 1) * DIGEST + 1, (RUN - 1 - inside) * DIGEST)
        return F.struct(before.cast("string").alias("before"), after.cast("string").alias("after"))

    return F.slice(F.array(*[level(k) for k in range(HEIGHT)]), F.lit(1), F.col("height")).cast(_PATH)


def _climb(nodes: DataFrame, largest: int, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Give nodes (g, pos, n, hash, own) their path, and subroot and root as `finish` finds them for the
    last node of each group."""
    if largest <= 1:
        return finish(nodes)
    blocks = stored(_blocks(nodes), "blocks")
    tops = blocks.select(
        "g", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("hash"),
        F.lit(None).cast(nodes.schema["own"].dataType).alias("own"),
    )
    parents = _climb(tops, -(-largest // BLOCK), finish).select(
        "g", F.col("pos").alias("block"), F.col("path").alias("_above"), "subroot", "root"
    )
    opened = blocks.join(parents, ["g", "block"]).select(
        "g", "block", "height", "l0", "l1", "l2", "_above", "subroot", "root",
        F.posexplode("rows").alias("_place", "own"),
    )
    return opened.select(
        "g",
        (F.col("block") * BLOCK + F.col("_place")).alias("pos"),
        "own",
        F.concat(_segments(F.col("_place")), F.col("_above")).alias("path"),
        "subroot",
        "root",
    )


def _last_tree(tops: DataFrame) -> DataFrame:
    """The tree over the groups' last nodes, in the order of the groups."""
    own = F.struct("g", "pos", "own", F.col("hash").alias("subroot"))
    nodes = tops.select(F.lit("").alias("g"), F.col("g").alias("_group"), "hash", own.alias("own"))
    placed, groups = _placed(nodes, ["_group"])
    top = F.col("hash")
    alone = lambda last: last.select(
        "g", "pos", "own", F.array().cast(_PATH).alias("path"), top.alias("subroot"), top.alias("root")
    )
    found = _climb(placed.drop("_group"), groups, alone)
    return found.select("own.g", "own.pos", "own.own", "path", "own.subroot", "root")


def manifest(leaves: DataFrame, group: str, order: str) -> DataFrame:
    """Add path, subroot and root to leaves (with a column `leaf`, the digest).

    Per value of `group` the leaves ascend by `order`, rows with equal `order` by their digest;
    null comes first in both. Groups are ordered by their bytes. `path` holds a struct per
    level, from the leaf to the root: the digests before and after the node in its run. A lone
    leaf is its own subroot, a lone group's subroot is the root; an empty table stays empty.
    """
    g = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    own = F.struct(*leaves.columns)
    nodes = leaves.select(g.alias("g"), F.col(order).alias("_order"), F.col("leaf").alias("hash"), own.alias("own"))
    placed, largest = _placed(nodes, ["_order", "hash"])
    return _climb(placed.drop("_order"), largest, _last_tree).select("own.*", "path", "subroot", "root")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest, proofs and a check of tampered rows; a row without id is never tampered with."""
    docs = table(spark, sf_dir, "documents")
    changed = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.col("doc_id").isNotNull() & (crc32_mod(F.col("doc_id"), 3) == 0) & (changed != F.col("text"))
    other = leaf_digest(*[changed if f == "text" else F.col(f) for f in FIELDS])
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").alias("lang"),
        leaf_digest(*[F.col(f) for f in FIELDS]).alias("leaf"),
        F.when(tampered, other).alias("tampered"),
    )
    # stored, as finding the range bounds reads the leaves once more
    found = manifest(stored(leaves, "leaves"), "lang", "doc_id").withColumn(
        "folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path"))
    )
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}


def _framed_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_framed_sql(text if f == "text" else f) for f in FIELDS) + ")"


_TREE_SQL = """
  SELECT tree, level + 1 AS level, pos // 8 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h,
         (any_value(c) + 7) // 8 AS c
  FROM {name} WHERE c > 1 GROUP BY tree, level, pos // 8
"""
_LOWER_SQL = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
ORACLE = {
    "op12_merkle_manifest": f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree, {_leaf_sql("text")} AS leaf,
         CASE WHEN {CRC32_SQL.format(text="CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_leaf_sql(_LOWER_SQL)}
              ELSE {_leaf_sql("text")} END AS given
  FROM documents
),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos FROM leaves),
low(tree, level, pos, h, c) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM placed
  UNION ALL {_TREE_SQL.format(name="low")}
),
subs AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM low WHERE c = 1),
high(tree, level, pos, h, c) AS (
  SELECT '', 0, pos, h, count(*) OVER () FROM subs
  UNION ALL {_TREE_SQL.format(name="high")}
),
way AS (
  SELECT doc_id, placed.pos AS leaf_pos, placed.tree AS leaf_tree, level AS k, h, low.pos AS pos,
         placed.pos // CAST(pow(8, level) AS BIGINT) AS own
  FROM placed JOIN low ON low.tree = placed.tree AND c > 1
   AND low.pos // 8 = placed.pos // CAST(pow(8, level + 1) AS BIGINT)
  UNION ALL
  SELECT doc_id, placed.pos, placed.tree, 100 + level, high.h, high.pos, subs.pos // CAST(pow(8, level) AS BIGINT)
  FROM placed JOIN subs ON subs.tree = placed.tree JOIN high ON c > 1
   AND high.pos // 8 = subs.pos // CAST(pow(8, level + 1) AS BIGINT)
),
segments AS (
  SELECT leaf_tree, leaf_pos, row_number() OVER (PARTITION BY leaf_tree, leaf_pos ORDER BY k) AS k,
         coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos < own), '') AS before,
         coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos > own), '') AS after
  FROM way GROUP BY leaf_tree, leaf_pos, way.k
),
proofs AS (
  SELECT leaf_tree, leaf_pos, sha256(string_agg(before || after, '' ORDER BY k)) AS proof FROM segments GROUP BY ALL
),
folded(tree, pos, k, node) AS (
  SELECT tree, pos, 0, given FROM placed
  UNION ALL
  SELECT f.tree, f.pos, f.k + 1, sha256(before || node || after)
  FROM folded f JOIN segments s ON s.leaf_tree = f.tree AND s.leaf_pos = f.pos AND s.k = f.k + 1
),
ends AS (SELECT tree, pos, arg_max(node, k) AS node FROM folded GROUP BY ALL)
SELECT doc_id, leaf, subs.h AS subroot, high.h AS root, coalesce(proof, sha256('')) AS proof_sha256,
       node AS folded_root, node = high.h AS verified
FROM placed JOIN subs USING (tree) JOIN ends ON ends.tree = placed.tree AND ends.pos = placed.pos
JOIN high ON high.c = 1 LEFT JOIN proofs ON leaf_tree = placed.tree AND leaf_pos = placed.pos
"""
}
