"""Fingerprints of tables with hot ids, against plain Python."""

import hashlib
from bisect import bisect_right
from collections import Counter

import pytest
from pyspark.sql import functions as F

from almanac.llm import merkle

SCHEMA = "doc_id bigint, text string"


def brute(spark, rows):
    """(doc_id, edited_sha256, equal to the next one) of every row, in the order the docstring states."""
    ties = spark.createDataFrame([(t or "",) for t in {t for _, t in rows}], "t string")
    tie = {r["t"]: r["h"] for r in ties.select("t", F.xxhash64("t").alias("h")).collect()}
    known = [(i, t or "") for i, t in rows]
    ordered = sorted(known, key=lambda r: (r[0] is None, -(r[0] or 0), -tie[r[1]]))
    out = Counter()
    for k, (i, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        out[(i, len(text), hashlib.sha256(edited.encode()).hexdigest(), text == after)] += 1
    return out


def story(i):
    return f"Story {i} of the river.\n" + "\n".join(f"line {i * k} runs on" for k in range(1, 2 + i % 5))


TABLES = {
    "null ids": [(None, story(i)) for i in range(60)] + [(i, story(i)) for i in range(40)],
    "one id": [(7, story(i)) for i in range(60)] + [(i, story(i)) for i in range(20)],
    "copies of a row": [(7, story(1))] * 50 + [(7, story(i)) for i in range(20)] + [(i, story(i)) for i in range(20)],
    "copies without id": [(None, None)] * 50 + [(None, story(i)) for i in range(20)] + [(3, story(3))] * 30,
    "one row many times": [(5, story(5))] * 40,
    "two hot ids": [(1, story(i % 3)) for i in range(50)] + [(2, story(i)) for i in range(50)] + [(0, ""), (9, "z")],
    "ids no double holds": [(2**60 + 3, story(i)) for i in range(50)] + [(2**60 + i, story(i)) for i in range(9)],
    "extreme ids": [(2**63 - 1, story(i)) for i in range(30)] + [(-(2**63), story(i)) for i in range(30)],
}


@pytest.mark.parametrize("name", TABLES)
def test_hot_ids_and_copies_against_brute_force(spark, name, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES_PER_TASK", 7)
    rows = TABLES[name]
    got = merkle.edit_prints(spark.createDataFrame(rows, SCHEMA)).collect()
    found = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_next"] == 1.0) for r in got)
    assert found == brute(spark, rows)


def test_hot_ids_are_dealt_to_several_stretches(spark):
    rows = [(None, story(i)) for i in range(900)] + [(i, story(i)) for i in range(100)]
    text = F.col("text")
    given = spark.createDataFrame(rows, SCHEMA).select(F.col("doc_id").alias("_id"), text, merkle._tie(text).alias("_tie"))
    dealt = merkle.layout(given)
    sizes = [r["count"] for r in given.groupBy(dealt.bucket()).count().collect()]
    assert max(sizes) < 400
    copies = spark.createDataFrame([(4, "same text")] * 900 + rows[-100:], SCHEMA)
    given = copies.select(F.col("doc_id").alias("_id"), text, merkle._tie(text).alias("_tie"))
    kept = merkle.collapsed(given, merkle.layout(given))
    assert kept.count() == 101 and kept.agg(F.sum("_more")).first()[0] == 899


def test_paragraphs_cover_the_text_and_realign(spark):
    line = " ".join(f"word{i * 7919 % 101} runs to the sea" for i in range(60))
    texts = [(line, "x" + line), (line, line[:900] + "XY" + line[900:]), ("a" * 500, "b" + "a" * 500), (story(3), "Z" + story(3))]
    df = spark.createDataFrame(texts, "a string, b string")
    a, b = F.col("a"), F.col("b")
    parts = F.array_join(F.regexp_extract_all(b, F.lit(merkle.PARAGRAPH), F.lit(0)), "")
    near = merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(b))
    rows = df.select((parts == b).alias("whole"), near.alias("near")).collect()
    assert all(r["whole"] for r in rows)
    assert rows[0]["near"] > 0.9 and rows[1]["near"] > 0.85 and rows[3]["near"] > 0


def test_stretches_are_found_by_halving(spark):
    values = [-(2**63), -5, 0, 7, 8, 2**60 + 3, 2**63 - 1]
    keys = [v + d for v in values for d in (-1, 0, 1) if -(2**63) <= v + d < 2**63]
    rows = spark.createDataFrame([(k,) for k in [*keys, None]], "k bigint")
    for n in range(len(values) + 1):
        found = {r["k"]: r["n"] for r in rows.select("k", merkle._at_most(values[:n], F.col("k")).alias("n")).collect()}
        assert found == {k: bisect_right(values[:n], k) for k in keys} | {None: 0}


def test_a_row_is_dealt_and_printed_once_however_many_the_stretches(spark):
    """The list of stretches was gone through for every row, and the bounds again for each of them."""
    for rows in ([(i, story(i)) for i in range(64)], TABLES["two hot ids"]):
        printed = merkle.edit_prints(spark.createDataFrame(rows, SCHEMA))
        plan = printed._jdf.queryExecution().optimizedPlan().toString()
        dealing = plan[: plan.rindex("RepartitionByExpression")], plan[plan.rindex("RepartitionByExpression") :]
        assert "filter([" not in plan
        # once for the text, after the shuffle, and once for the edited text
        assert [part.count("regexp_extract_all") for part in dealing] == [2, 0]


def test_many_stretches_give_the_same_rows(spark):
    rows = [(i * i, story(i)) for i in range(300)] + [(None, story(i)) for i in range(9)] + [(4, story(i)) for i in range(9)]
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        got = merkle.edit_prints(spark.createDataFrame(rows, SCHEMA)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_next"] == 1.0) for r in got) == brute(spark, rows)
