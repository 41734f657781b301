"""Near-duplicate documents by SuperMinHash signatures.

A signature has 128 values. Every shingle draws a permutation of the 128 places, one place
per round, and puts (round + a random fraction) there; the least value of each place stays.
As one shingle's places are all different, the values of a signature are negatively correlated and vary less than
those of plain MinHash. When all places of a document are filled in a round, later rounds could only
put larger values, so the document stops: documents of some hundred words need two or three
rounds instead of 128.

Documents with equal shingle sets are one class. Classes that agree in one of 32 bands of four values
share a bucket; a pair with similarity 0.8 is missed with a probability of
(1 - 0.8 ** 4) ** 32 = 5e-8. In a bucket, members are compared in a chain first, links
confirmed on the full sets join components, and then the members outside a bucket's largest
component are compared with all its other components, exactly, in blocks of bounded size. Members that no
other member of the bucket comes near in size are left out, as are buckets of two, which the
chain has decided. Only links leave these tasks, so a bucket with thousands of near copies makes
no list of pairs, and none of its links between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm.common import mixed, stored, table
from almanac.llm.shingles import groups, shingle_sets

PLACES = 128
BANDS = 32
# 100 * intersection >= PERCENT * union
PERCENT = 80
# Members of a bucket that are chained in one task.
CHAIN = 20_000
MOST_CHAINS = 2
# Characters of the texts on either side that one task compares with each other.
BLOCK_CHARS = 4_000_000
# Buckets of up to so many members are searched for members that none of the others comes near in size.
SIZED = 10_000
# Links whose union-find one task holds in memory, about 100 MB.
TASK_LINKS = 400_000
# Documents per file of the frames that are kept between the steps, and distinct shingles per file of texts.
FILE_ROWS = 20_000
FILE_SHINGLES = 500_000
OUTPUTS = ("n_shingles", "component_id", "kept")

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_ALL = (1 << 64) - 1


def signatures(hashes: np.ndarray, owner: np.ndarray, n: int, places: int = PLACES) -> np.ndarray:
    """SuperMinHash signatures of `n` sets, given as element hashes and the set of each."""
    out = np.full((n, places), np.inf)
    flat = out.reshape(-1)

    def drawn(j: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = mixed(h + _U((j + 1) * int(_STEP) & _ALL))
        share = (x >> _U(11)).astype(np.float64) * 2.0**-53
        y = mixed(x ^ _U(0xA0761D6478BD642F)) >> _U(32)
        return share, (j + ((y * _U(places - j)) >> _U(32)).astype(np.int64))

    def open_sets(j: int) -> np.ndarray:
        return out.max(axis=1) >= j + 1

    share, k = drawn(0, hashes)
    np.minimum.at(flat, owner * places + k, share)
    rows = np.flatnonzero(open_sets(0)[owner])
    if not rows.size:
        return out
    # the permutations are only drawn on where a second round is needed
    h, own = hashes[rows], owner[rows]
    order = np.tile(np.arange(places, dtype=np.int16), (len(rows), 1))
    order[np.arange(len(rows)), k[rows]] = 0
    at = np.arange(len(rows))
    for j in range(1, places):
        share, k = drawn(j, h[at])
        place = order[at, k]
        order[at, k] = order[at, j]
        np.minimum.at(flat, own[at] * places + place, share + j)
        at = at[open_sets(j)[own[at]]]
        if not at.size:
            break
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band, which tells the bands apart as well."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, -1)
    key = mixed(np.arange(1, bands + 1, dtype=np.uint64) * _STEP)[None, :].repeat(len(signature), 0)
    for i in range(bits.shape[2]):
        key = mixed(key ^ bits[:, :, i])
    return key.view(np.int64)


def class_key(shingles: np.ndarray) -> bytes:
    """128 bits that two different sets do not share."""
    total = np.add.reduce(mixed(shingles ^ _STEP), dtype=np.uint64)
    crossed = np.bitwise_xor.reduce(mixed(shingles + _STEP))
    return np.array([total + _U(len(shingles)), crossed], np.uint64).tobytes()


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in groups(batch.column(1)):
            sets = list(shingle_sets(texts))
            sizes = np.array([len(s) for s in sets], np.int64)
            filled = np.flatnonzero(sizes)
            bands: list = [None] * len(sets)
            if filled.size:
                elements = np.concatenate([sets[i] for i in filled])
                owner = np.repeat(np.arange(len(filled)), sizes[filled])
                keys = band_keys(signatures(elements, owner, len(filled)))
                for row, i in enumerate(filled):
                    bands[i] = keys[row]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, len(texts)),
                    pa.array(sizes),
                    pa.array([class_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "cls", "bands"],
            )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with both texts, those that are linked on their full sets."""
    known: dict[bytes, np.ndarray | None] = {}

    def full(key: bytes, text: pa.Array) -> np.ndarray | None:
        if key not in known:
            if len(known) > 64:
                known.clear()
            found = next(shingle_sets(text))
            # a repeated id may bring another text
            known[key] = found if len(found) and class_key(found) == key else None
        return known[key]

    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keep = []
        for i in range(batch.num_rows):
            x, y = full(a[i], batch.column(2).slice(i, 1)), full(b[i], batch.column(3).slice(i, 1))
            if x is None or y is None:
                known.pop(a[i], None)
                known.pop(b[i], None)
                continue
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= PERCENT * (len(x) + len(y) - common):
                keep.append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array([a[i] for i in keep], pa.binary()), pa.array([b[i] for i in keep], pa.binary())], ["a", "b"]
        )


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the links of one task: each node with the root of its set."""
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for frame in frames:
        for a, b in zip(frame["a"], frame["b"]):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    rows = [(x, root(x)) for x in parent]
    yield pd.DataFrame([(x, r) for x, r in rows if x != r], columns=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of links (a, b) that are not their own root.

    Union-find within tasks of at most about `TASK_LINKS` links shrinks the links to forests. While there
    is more than one task, a round merges every node into the neighbour, or itself, that comes
    first in an order drawn anew per round; that leaves a fraction of the nodes, so a long chain takes a
    logarithmic number of rounds. The forest of the last, single task completes the labels.
    """
    left, labels, round_ = links, None, 0
    while True:
        round_ += 1
        tasks = max(1, -(-left.count() // TASK_LINKS))
        left = stored(left.repartition(tasks).mapInPandas(_forest, "a binary, b binary"), "forest")
        if tasks == 1:
            return _relabelled(labels, left.select(F.col("a").alias("node"), F.col("b").alias("root")))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.lit(round_), c).alias("h"), c.alias("id"))
        best = both.groupBy("a").agg(F.min(order(F.col("b"))).alias("n"))
        merged = stored(
            best.select(F.col("a").alias("node"), F.least(order(F.col("a")), F.col("n"))["id"].alias("root")), "merged"
        )
        labels = _relabelled(labels, merged)
        ends = left.join(merged.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
        ends = ends.join(merged.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
        ends = ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        left = stored(ends.distinct(), "ends")


def _relabelled(labels: DataFrame | None, over: DataFrame) -> DataFrame:
    """Labels (node, root) whose roots are given other roots by `over`."""
    if labels is None:
        return over
    tops = over.select(F.col("node").alias("root"), F.col("root").alias("top"))
    old = labels.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    fresh = over.join(labels.select("node"), "node", "left_anti").select("node", "root")
    return stored(old.unionByName(fresh), "labels")


def _sizes_allow(a: Column, b: Column) -> Column:
    """Whether sets of these sizes can be linked: they share at most the smaller and cover at least the larger."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _pairs_of(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    one = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(_linked, "a binary, b binary")


def _class_components(classes: DataFrame, docs: DataFrame, files: int, text_files: int) -> DataFrame:
    """(node, root) for the classes that are linked with another one; frames are kept in so many files at most."""
    entries = classes.select("cls", "size", F.explode(F.array_distinct("bands")).alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(entries.join(shared, "key"), "members", files=files)
    wanted = members.select("cls").distinct().join(classes.select("cls", "rep"), "cls")
    given = docs.select(F.col("doc_id").alias("_id"), "text")
    texts = given.join(wanted, given["_id"].eqNullSafe(wanted["rep"])).select("cls", "text")
    texts = stored(texts, "texts", files=text_files)
    labels, tested, before = None, None, float("inf")
    rest = members
    for chain in range(MOST_CHAINS):
        # a very large bucket is chained in several parts, others in each round and band
        part = F.pmod(F.xxhash64(F.lit(chain), "key", "cls"), F.ceil(F.col("n") / CHAIN).cast("long"))
        along = Window.partitionBy("key", part).orderBy(F.xxhash64(F.lit(-chain), "key", "cls"), "cls")
        cols = ["cls", "size"] if labels is None else ["cls", "size", "root"]
        chained = rest.select(*cols, *[F.lead(c).over(along).alias(f"next_{c}") for c in cols])
        chained = chained.where("next_cls is not null" if labels is None else "next_root <> root")
        chained = chained.where(_sizes_allow(F.col("size"), F.col("next_size")))
        pairs = chained.select(*_pairs_of(F.col("cls"), F.col("next_cls"))).distinct()
        pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs", files=files)
        tested = pairs if tested is None else tested.unionByName(pairs)
        # texts are compared in all tasks there are, and the few links go on to few
        labels = _merged(labels, stored(_confirm(pairs, texts).repartition(files), "links"), files)
        rest = stored(_open(members, labels), "open", files=files)
        sizes = rest.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
            F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("squares")
        )
        got = sizes.agg(
            F.sum("all").alias("rows"), F.sum((F.col("all") * F.col("all") - F.col("squares")) / 2).alias("pairs")
        ).first()
        if not got["rows"]:
            return labels
        # few pairs are left, or those that are left are not linked: another chain would not help
        if got["pairs"] <= got["rows"] or 2 * got["pairs"] > before:
            break
        before = got["pairs"]
    return _merged(labels, stored(_compared(rest, texts, files), "links", files=files), files)


def _across(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one block: links between its queries and members of other components, by exact counts.

    The members' shingles are an index in memory; a query counts the hits per member.
    """
    members, queries = frame[~frame["query"]], frame[frame["query"]]
    out: list[tuple[bytes, bytes]] = []

    def sets(rows: pd.DataFrame) -> Iterator[tuple[bytes, bytes, np.ndarray]]:
        for at, texts in groups(pa.array(rows["text"], pa.string())):
            part = rows.iloc[at : at + len(texts)]
            for key, root, found in zip(part["cls"], part["root"], shingle_sets(texts)):
                # a repeated id may bring another text
                if len(found) and class_key(found) == key:
                    yield key, root, found

    keys, roots, found = [], [], []
    for key, root, shingles in sets(members):
        keys.append(key)
        roots.append(root)
        found.append(shingles)
    if keys and len(queries):
        sizes = np.array([len(x) for x in found])
        every, owner = np.concatenate(found), np.repeat(np.arange(len(found)), sizes)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        for key, root, shingles in sets(queries):
            first, last = np.searchsorted(every, shingles), np.searchsorted(every, shingles, side="right")
            lengths = last - first
            total = int(lengths.sum())
            if not total:
                continue
            places = np.repeat(first - np.cumsum(lengths) + lengths, lengths) + np.arange(total)
            common = np.bincount(owner[places], minlength=len(keys))
            near = 100 * common >= PERCENT * (len(shingles) + sizes - common)
            linked: set[bytes] = set()  # one link to each other component is enough
            for i in np.flatnonzero(near):
                if roots[i] != root and roots[i] not in linked:
                    linked.add(roots[i])
                    out.append((min(key, keys[i]), max(key, keys[i])))
    return pd.DataFrame(out, columns=["a", "b"])


def _with_partner(rest: DataFrame) -> DataFrame:
    """Members of open buckets that another member comes near enough in size, but for buckets of two.

    In the order of sizes the nearest partner stands next to a member. Large buckets are kept whole.
    """
    along = Window.partitionBy("key").orderBy("size", "cls")
    near = [F.coalesce(_sizes_allow(F.col("size"), of("size").over(along)), F.lit(False)) for of in (F.lag, F.lead)]
    small = rest.where((F.col("n") > 2) & (F.col("n") <= SIZED)).withColumn("near", near[0] | near[1]).where("near")
    return rest.where(F.col("n") > SIZED).unionByName(small.drop("near"))


def _units(frame: pd.DataFrame) -> pd.DataFrame:
    """Links of the blocks of one task."""
    return pd.concat([_across(block) for _, block in frame.groupby(["key", "mb", "qb"], sort=False)])


def _compared(rest: DataFrame, texts: DataFrame, files: int) -> DataFrame:
    """Links between members of one bucket that are in different components, all of them tested.

    The members outside a bucket's largest component are its queries. A large bucket is cut
    into blocks of members and of queries, and each block of either kind meets each of the other,
    so no task holds more than two blocks; small buckets are dealt to units of about a quarter of one.
    Only links leave a task.
    """
    known = texts.groupBy("cls").agg(F.max(F.length("text")).alias("chars"))
    entries = stored(_with_partner(rest).select("key", "cls", "root").join(known, "cls"), "entries", files=files)
    units = 1 + 4 * (entries.agg(F.sum("chars")).first()[0] or 0) // BLOCK_CHARS
    parts = entries.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"), F.sum("chars").alias("chars"))
    blocks = parts.groupBy("key").agg(
        F.max(F.struct("m", "root", "chars")).alias("top"), F.sum("chars").alias("chars")
    ).select(
        "key", F.col("top.root").alias("most"),
        F.ceil(F.col("chars") / BLOCK_CHARS).cast("int").alias("member_blocks"),
        F.ceil((F.col("chars") - F.col("top.chars")) / BLOCK_CHARS).cast("int").alias("query_blocks"),
    )
    rows = entries.drop("chars").join(blocks, "key")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.greatest(F.col(n), F.lit(1)) - 1))
    dealt = lambda n, k: F.pmod(F.xxhash64("cls", F.lit(k)), F.greatest(F.col(n), F.lit(1))).cast("int")
    own = ["key", "cls", "root"]
    given = [*own, "member_blocks"]
    members = rows.select(
        *given, F.lit(False).alias("query"), dealt("member_blocks", 1).alias("mb"), each("query_blocks").alias("qb")
    )
    queries = rows.where("root <> most").select(
        *given, F.lit(True).alias("query"), each("member_blocks").alias("mb"), dealt("query_blocks", 2).alias("qb")
    )
    whole = F.pmod(F.xxhash64("key"), F.lit(units))
    every = members.unionByName(queries).select(
        *own, "query", "mb", "qb", (F.col("member_blocks") > 1).alias("cut"),
        F.when(F.col("member_blocks") > 1, F.xxhash64("key", "mb", "qb")).otherwise(whole).alias("unit"),
    )
    return every.join(texts, "cls").groupBy("cut", "unit").applyInPandas(_units, "a binary, b binary").distinct()


def _merged(labels: DataFrame | None, links: DataFrame, files: int) -> DataFrame:
    """Labels (node, root) with the components that new links join."""
    if labels is not None:
        for end in ("a", "b"):
            known = labels.select(F.col("node").alias(end), "root")
            links = links.join(known, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        links = stored(links.where("a <> b").distinct(), "links", files=files)
    return _relabelled(labels, components(links))


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with their root."""
    known = labels.select(F.col("node").alias("cls"), "root")
    rooted = members.join(known, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    mixed_keys = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return rooted.join(mixed_keys.select("key"), "key")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents without a word, and null texts, have no shingle and are linked with nothing. Texts with equal
    sets are one class whatever their ids; a repeated id is a row each time, and kept in each
    row if it is the smallest of its component. A null id is never kept unless it stands
    alone; an empty table gives an empty table.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = stored(
        given.mapInArrow(_prints, "doc_id bigint, n_shingles bigint, cls binary, bands array<bigint>"), "prints"
    )
    total = prints.agg(F.count(F.lit(1)).alias("rows"), F.sum("n_shingles").alias("shingles")).first()
    files, text_files = 1 + total["rows"] // FILE_ROWS, 1 + (total["shingles"] or 0) // FILE_SHINGLES
    filled = prints.where("cls is not null")
    classes = stored(
        filled.groupBy("cls").agg(
            F.min("doc_id").alias("rep"), F.min("n_shingles").alias("size"), F.min("bands").alias("bands")
        ),
        "classes",
        files=files,
    )
    labels = _class_components(classes, given, files, text_files)
    rooted = classes.select("cls", "rep").join(labels, classes["cls"] == labels["node"], "left").select(
        "cls", "rep", F.coalesce("root", "cls").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_class = stored(rooted.join(least, "root").select("cls", "component_id"), "components", files=files)
    found = filled.drop("bands").join(of_class, "cls")
    alone = prints.where("cls is null").drop("bands").withColumn("component_id", F.col("doc_id"))
    component = F.col("component_id")
    return found.unionByName(alone).select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents of which `near_duplicates` keeps the id, with all their columns."""
    keep = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_keep")).distinct()
    return docs.join(keep, docs["doc_id"].cast("long").eqNullSafe(keep["_keep"]), "left_semi")


def op3_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op3_superminhash": op3_superminhash}

# Links by brute force: pairs that share a shingle, their common shingles counted.
ORACLE = {
    "op3_superminhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
           WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
           ELSE list_transform(range(1, len(words) - 2),
                               lambda i: words[i] || ' ' || words[i+1] || ' ' || words[i+2] || ' ' || words[i+3]) END) AS shingles
  FROM w
), e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
f AS (SELECT shingle FROM e GROUP BY shingle HAVING count(*) > 1),
g AS (SELECT doc_id, n, shingle FROM e WHERE shingle IN (SELECT shingle FROM f)),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM g a JOIN g b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), r(node, reached) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.node, p.b FROM r JOIN p ON r.reached = p.a
), c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN c ON s.doc_id = c.node
"""
}
