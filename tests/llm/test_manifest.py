"""Manifests against a plain tree, for group sizes around the borders of runs and blocks."""

import hashlib

import pytest
from pyspark.sql import functions as F

from almanac.llm import manifest
from tests.llm.rows import awkward, empty


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """Root and per leaf the siblings (before, after) of each level."""
    paths = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, at in enumerate(place):
            run = at // 8 * 8
            paths[leaf].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 8])))
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        place = [at // 8 for at in place]
    return nodes[0], paths


def plain(leaves):
    """leaves: (lang, doc_id, leaf) -> {(lang, doc_id, leaf): (subroot, root, path)}"""
    groups = {}
    for lang, ident, leaf in leaves:
        groups.setdefault((lang is not None, (lang or "").encode()), []).append((ident, leaf, lang))
    subs = {g: (sorted(rows), *tree([r[1] for r in sorted(rows)])) for g, rows in groups.items()}
    order = sorted(subs)
    root, above = tree([subs[g][1] for g in order])
    out = {}
    for g, up in zip(order, above):
        rows, sub, paths = subs[g]
        for (ident, leaf, lang), path in zip(rows, paths):
            out[lang, ident, leaf] = (sub, root, path + up)
    return out


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 2, 8, 64, 65], [511, 512, 513, 3], [4097, 1, 600]])
def test_against_a_plain_tree(spark, sizes):
    leaves = [
        (None if k == 1 else f"lang{k}é", i * 3 % (7 * n), h(str(k), str(i)))
        for k, n in enumerate(sizes)
        for i in range(n)
    ]
    df = spark.createDataFrame(leaves, "lang string, doc_id bigint, leaf string").repartition(5)
    want = plain(leaves)
    rows = manifest.manifest(df, "lang", "doc_id").withColumn("folded", manifest.fold(F.col("leaf"), F.col("path")))
    rows = rows.collect()
    assert len(rows) == len(leaves)
    for r in rows:
        sub, root, path = want[r["lang"], r["doc_id"], r["leaf"]]
        assert (r["subroot"], r["root"]) == (sub, root) and r["folded"] == root
        assert [(s["before"], s["after"]) for s in r["path"]] == path


def test_many_groups(spark):
    leaves = [(f"g{i % 700}", i, h(str(i))) for i in range(1500)]
    df = spark.createDataFrame(leaves, "lang string, doc_id bigint, leaf string")
    want = plain(leaves)
    for r in manifest.manifest(df, "lang", "doc_id").collect():
        assert (r["subroot"], r["root"]) == want[r["lang"], r["doc_id"], r["leaf"]][:2]


def test_awkward_rows(spark, tmp_path):
    awkward(spark).write.parquet(f"{tmp_path}/documents.parquet")
    rows = manifest.op12_merkle_manifest(spark, str(tmp_path)).collect()
    given = awkward(spark).collect()
    leaves = [
        (r["lang"], r["doc_id"], h(*[framed(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")]))
        for r in given
    ]
    assert sorted(r["leaf"] for r in rows) == sorted(leaf for *_, leaf in leaves)
    # equal rows stand side by side, so their digests and roots are the same
    assert len({r["root"] for r in rows}) == 1
    for r in rows:
        assert r["verified"] == (r["folded_root"] == r["root"])
        if r["doc_id"] in (None, 3, 4, 5):
            assert r["verified"]
    assert not all(r["verified"] for r in rows)


def test_empty_table(spark, tmp_path):
    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert manifest.op12_merkle_manifest(spark, str(tmp_path)).count() == 0


def test_a_changed_leaf_does_not_verify(spark):
    leaves = [("a", i, h(str(i))) for i in range(600)]
    df = spark.createDataFrame(leaves, "lang string, doc_id bigint, leaf string")
    found = manifest.manifest(df, "lang", "doc_id")
    bad = found.where(manifest.fold(F.sha2(F.lit("other"), 256), F.col("path")) == F.col("root"))
    assert bad.count() == 0
