import hashlib
import re

import pytest
from pyspark.sql import functions as F

from almanac.llm import secret_scan as S
from tests.llm.rows import HAVE_TABLES, SF_DIR, awkward, empty

ASSIGN = re.compile(
    r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def base_texts(df):
    rows = df.select("doc_id", "text", S.digest(S.F.col("base_spans")).alias("b"), S.digest(S.F.col("spans")).alias("s"))
    return rows.collect()


def test_edges(spark):
    rows = base_texts(S.scan(awkward(spark)))
    assert len(rows) == 12
    for row in rows:
        assert row["b"] == brute(row["text"])
        assert set(filter(None, row["b"].split(","))) <= set(row["s"].split(","))
    assert S.scan(empty(spark)).count() == 0


def test_consumed_matches_and_planted(spark):
    texts = [
        "token: secret: abcdefghijklmn",
        "API_KEY=\"x.y=z+/_-1234567890\" apikey='short'",
        "passwd = aaaa token==" + "b" * 30,
        "AKIAAKIA" + "A1" * 8 + " " + "f" * 15 + "g" + "0" * 16,
        "xx 0123456789abcdef0123 yy 0123456789abcdef0123",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in base_texts(S.scan(df)):
        assert row["b"] == brute(row["text"]), row["text"]


def test_models_tell_random_from_words(spark):
    words = ["internationalisation", "characterization", "SupportedFunctions", "UNCHARACTERISTICALLY", "misunderstandings"]
    known = [f"password={hashlib.sha256(str(i).encode()).hexdigest()[:24]}" for i in range(60)]
    train = spark.createDataFrame(
        [(i, f"{' '.join(words)} {k}") for i, k in enumerate(known)], "doc_id bigint, text string"
    )
    ratios = S.train(train)
    probe = spark.createDataFrame(
        [(1, "zz 7f3K9d-2b8e1c4a6f0d9b zz"), (2, "the SupportedFunctionsCharacterization here")],
        "doc_id bigint, text string",
    )
    got = {r["doc_id"]: r["s"] for r in base_texts(S.scan(probe, ratios))}
    assert got[1] == "random:3:24"[: len(got[1])] and got[1].startswith("random:3:") and got[2] == ""


ORDINARY = [
    "ThisIsAVeryLongCamelCaseIdentifier", "getHTTPResponseCodeFromURL", "/usr/local/lib/python3/site-packages",
    "-" * 23, "=" * 40, "=-=-=-=-=-=-=-=-=-=-", "MAXIMUM_NUMBER_OF_CONNECTIONS", "the_number_of_open_windows_2",
    "report-2024-01-31_final-version", "123e4567-e89b-42d3-a456-426614174000", "4952-9359-0025-3052",
    "zzzzzzzzzzzzzzzzzzzzzzzz", "input/words=letters+numbers", "XMLDocumentReaderFactory", "state-of-the-art-systems",
]
RANDOM = [
    "kR7vQz2XpL9mWb4TnY8c", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "Zx8Kq2Vw+9LmT4/RbYp7Hs==",
    "q7zk2xv9wj4ph8mt3dbr", "sk_live_4Qz8XkV2wRj7TnB9", "xkqzvwjpfgqhzxbtkwvn",
]


@pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
def test_identifiers_and_rulers_are_no_false_alarms(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tokens = S.labelled_tokens(docs)
    ratios = S.ratios_of(tokens)
    margin = S.margin_of(tokens, ratios)
    probe = spark.createDataFrame([(i, f"see {t} here") for i, t in enumerate(ORDINARY + RANDOM)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["s"] for r in base_texts(S.scan(probe, ratios, margin))}
    assert [ORDINARY[i] for i in range(len(ORDINARY)) if got[i]] == []
    for i, token in enumerate(RANDOM, len(ORDINARY)):
        assert got[i] == f"random:4:{4 + len(token)}", token


def plain_spans(text, ratios, margin):
    """What the method adds, said once more in plain Python."""
    number = {c: i + 1 for i, c in enumerate(S.SYMBOLS)}
    base = [tuple(map(int, p.split(":")[1:])) for p in filter(None, brute(text).split(","))]
    out = []
    for m in re.finditer(S.TOKEN, text or ""):
        codes = [0, *(number.get(c, 0) for c in m[0])]
        score = sum(ratios[a * S._N + b] for a, b in zip(codes, codes[1:])) / len(m[0])
        odd = len(set(m[0])) >= S.LEAST_DISTINCT and re.search("[A-Za-z]", m[0]) and not re.match(S.UUID, m[0])
        if odd and score > margin and not any(a < m.end() and m.start() < b for a, b in base):
            out.append(f"random:{m.start()}:{m.end()}")
    return out


@pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
def test_added_spans_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tokens = S.labelled_tokens(docs)
    ratios = S.ratios_of(tokens)
    margin = S.margin_of(tokens, ratios)
    rows = base_texts(S.scan(docs, ratios, margin))
    for row in rows:
        added = [s for s in row["s"].split(",") if s.startswith("random:")]
        assert added == plain_spans(row["text"], ratios, margin)
    assert S.op9_secret_scan(spark, SF_DIR).agg({"spans": "max"}).first()[0] == max(r["s"] for r in rows)


def test_redaction(spark):
    df = spark.createDataFrame([(1, "a password=0123456789abcdef0123 b"), (2, "plain")], "doc_id bigint, text string")
    out = S.scan(df).select("doc_id", S.redacted(S.F.col("text"), S.F.col("spans")).alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in out} == {1: f"a {S.PLACEHOLDER} b", 2: "plain"}


@pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
def test_query_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = S.op9_secret_scan(spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for row in rows:
        want = brute(docs[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [want.count(f"{k}:") for k in S.KINDS[:3]]


def test_learns_from_every_word_of_every_text(spark):
    spelled = lambda i: "".join(chr(97 + int(d)) for d in f"{i:08d}")
    long = [(" ".join(spelled(i) for i in range(1000)),)]
    tokens = [r["token"] for r in S.labelled_tokens(spark.createDataFrame(long, "text string")).collect()]
    assert {spelled(i) for i in range(1000)} <= set(tokens)
    many = spark.range(10_500).select(F.concat(F.lit("secret "), F.lit("AKIA"), F.format_string("%016d", "id")).alias("text"))
    assert S.labelled_tokens(many).where("label = 1 and token like 'AKIA%'").select("token").distinct().count() == 10_500


def test_pairs_are_counted_and_scored_in_batches(spark):
    tokens = spark.createDataFrame([(0, "ab"), (0, ""), (1, "ab/"), (0, None), (0, "abcdefghijklmnopqrst")], "label int, token string")
    pairs = tokens.select("label", F.explode(S._pairs(F.col("token"))).alias("pair"), "token").where("token != ''")
    want = {(r["label"], r["pair"]): r["count"] for r in pairs.groupBy("label", "pair").count().collect()}
    got = tokens.mapInArrow(S._count_pairs, "label int, pair int, n long").groupBy("label", "pair").agg(F.sum("n").alias("n"))
    assert {(r["label"], r["pair"]): r["n"] for r in got.collect()} == want
    ratios = [i / 100 for i in range(S._N * S._N)]
    score = tokens.where("label = 0 and length(token) > 16").select(S._score(F.col("token"), ratios).alias("s")).first()["s"]
    assert abs(S.margin_of(tokens, ratios) - score) < 1e-9


def test_learns_and_scans_without_python_on_the_executors(spark, monkeypatch):
    def refused(*args, **more):
        raise AssertionError("Python on the executors")

    tokens = spark.createDataFrame(
        [(0, "ab"), (0, ""), (1, "ab/"), (0, None), (0, "a.b-c=d"), (0, "abcdefghijklmnopqrst"), (1, "aaaa")], "label int, token string"
    )
    want = tokens.mapInArrow(S._count_pairs, "label int, pair int, n long").groupBy("label", "pair").agg(F.sum("n").alias("n")).collect()
    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(tokens), name, refused)
    assert S.pair_counts(tokens) == {(r["label"], r["pair"]): r["n"] for r in want}
    df = spark.createDataFrame([(1, "a password=0123456789abcdef0123 b"), (2, "plain words and kR7vQz2XpL9mWb4TnY8c")], "doc_id bigint, text string")
    scanned = S.scan(df)
    assert [s["kind"] for s in scanned.where("doc_id = 1").first()["spans"]] == ["assign", "hex"]
    assert not re.search("Python|Pandas|Arrow", scanned._jdf.queryExecution().executedPlan().toString())
