"""Spelling variants against brute force over all pairs, and the awkward rows."""

import random
import zlib

from pyspark.sql import functions as F

from almanac.llm import spelling
from tests.llm.rows import awkward, empty


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, factor=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def words_of(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n bigint")


def got(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def changed(word, rng, letters):
    at = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return word[:at] + rng.choice(letters) + word[at:]
    at = min(at, len(word) - 1)
    return word[:at] + (rng.choice(letters) if kind == 1 else "") + word[at + 1 :]


def test_near_words_by_brute_force(spark):
    rng = random.Random(7)
    letters = "abçÿ"
    pool = {"".join(rng.choice(letters) for _ in range(rng.randint(7, 12))) for _ in range(120)}
    for word in list(pool):
        pool.add(changed(changed(word, rng, letters), rng, letters))
        pool.add(changed(word, rng, letters))
    counts = {w: rng.choice([2, 3, 20, 30, 300, 3000]) for w in sorted(pool) if len(w) >= 7}
    assert got(spelling.variants(words_of(spark, counts))) == brute(counts)


def test_long_words_and_runs_of_one_letter(spark):
    rng = random.Random(8)
    long_word = "".join(rng.choice("abcdefgh") for _ in range(700))
    counts = {"a" * n: 10 ** (n % 5) * 2 for n in range(7, 60)}
    counts |= {changed(long_word, rng, "xyz"): 2 for _ in range(40)} | {long_word: 500}
    counts |= {("ab" * 40)[i : i + 45] + "c" * (i % 3): 3 + i for i in range(6)}
    assert got(spelling.variants(words_of(spark, counts))) == brute(counts)


def test_crowded_nodes_are_split(spark, monkeypatch):
    monkeypatch.setattr(spelling, "NODE_STATES", 5)
    rng = random.Random(9)
    counts = {}
    for _ in range(150):
        counts["unterwegs" + "".join(rng.choice("abc") for _ in range(rng.randint(2, 4)))] = rng.choice([2, 40])
    assert got(spelling.variants(words_of(spark, counts))) == brute(counts)


def test_chains_of_forms_end_at_the_last(spark):
    counts = {"abcdefgh": 2, "abcdefgx": 20, "abcdefyx": 200, "abcdezyx": 2000, "abcdezyy": 2000}
    rows = {r["word"]: r for r in spelling.variants(words_of(spark, counts)).collect()}
    assert [rows[w]["root"] for w in ("abcdefgh", "abcdezyx", "abcdezyy")] == ["abcdezyx", "abcdezyx", "abcdezyy"]
    assert rows["abcdezyx"]["form"] is None and rows["abcdezyx"]["form_n"] is None


def test_ties_go_to_the_smallest_word(spark):
    counts = {"wordlike": 2, "wordlika": 50, "wordlikz": 50, "ÿordlike": 50}
    rows = {r["word"]: r for r in spelling.variants(words_of(spark, counts)).collect()}
    assert rows["wordlike"]["form"] == "wordlika" and rows["wordlike"]["n_near"] == 3


def test_runs_lose_the_letter_their_hash_names(spark):
    texts = {i: f"Straßenbahn-{'ABCDEFGHIJKL'[: 7 + i % 5]} Éléphants×÷x short" for i in range(200)}
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id bigint, text string")
    want = []
    for i, t in texts.items():
        for run in ("straßenbahn", "ABCDEFGHIJKL"[: 7 + i % 5].lower(), "Éléphants×÷x"):
            h = zlib.crc32(f"{i}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            want += [word] if len(word) >= 7 else []
    assert sorted(r["word"] for r in spelling.planted_runs(df).collect()) == sorted(want)
    assert any(len(w) == 10 and w.startswith("stra") for w in want)


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = spelling.variants(spelling.counted(spelling.planted_runs(docs)))
    assert {"village"} <= {r["word"] for r in found.collect()}
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    none = spelling.variants(spelling.counted(spelling.planted_runs(empty(spark))))
    assert none.count() == 0
    nulls = docs.withColumn("text", F.lit(None).cast("string"))
    assert spelling.planted_runs(nulls).count() == 0
