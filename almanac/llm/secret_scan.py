"""Secret scans: fixed patterns, and character Markov models for what they miss.

Three patterns find assignments, access keys and hexadecimal runs. The method adds tokens
that look drawn at random: two first-order character models, one of random strings and one
of ordinary identifiers, give each token of 16 or more characters a log-likelihood ratio.
Both are trained on the whole corpus itself. What the patterns found is
random. Ordinary are the corpus's words, and identifiers in the usual styles (camel case,
underscores, hyphens, paths, capitals, numbers) spelled from words that follow each other, as
prose alone has hardly a capital, a sign or a digit inside a token. The threshold is set on the
same tokens, of all documents; the models are two tables of 67 by 67 numbers.

Not taken for random whatever the models say: tokens without a letter (numbers, rulers), of
few different characters, and UUIDs, which name things.

Tokens, their pairs, scores and spans are SQL functions inside the row of its document, so there
is no shuffle of texts and no group of rows that could grow hot: what is shuffled are counts of
pairs, summed in each task before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import let, quoted, stored, table, without

ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_HINT = r"(?i)password|passwd|secret|token|api_?key"
# A run of these characters is matched whole, so the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_VALUE = 12
KINDS = ("assign", "access", "hex", "random")
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_="
# The least mean log-likelihood ratio per character of a random token; more, if labelled
# identifiers beyond a share of `FALSE_ALARMS` would reach it.
MARGIN = 0.5
FALSE_ALARMS = 0.001
# Share of the random model that any letter or digit may follow any other.
UNIFORM = 0.5
# The same share of the ordinary model: a pair that the corpus lacks weighs no more in a large corpus than in a small one.
ORDINARY_UNIFORM = 0.01
LEAST_DISTINCT = 7
UUID = r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
PLACEHOLDER = "[SECRET]"

_N = len(SYMBOLS) + 1  # the rest, and the start, share number 0
_SPAN = "array<struct<start:int,end:int,kind:string,text:string>>"


def found(text: Column, pattern: str, hint: str | None = None) -> Column:
    """All matches with their places in code points, leftmost and without overlap."""

    def placed(matches: Column, between: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

        def step(acc: Column, i: Column) -> Column:
            begin = acc["at"] + F.length(F.get(between, i))
            end = begin + F.length(F.get(matches, i))
            span = F.struct(
                begin.alias("start"), end.alias("end"), F.lit("").alias("kind"), F.get(matches, i).alias("text")
            )
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).cast(_SPAN).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), start, step)["out"]

    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = let(every, lambda m: let(F.split(text, pattern, -1), lambda b: placed(m, b)))
    return F.when(text.rlike(hint or pattern) & text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: s.withField("kind", F.lit(kind)))


def base_spans(text: Column) -> Column:
    """The spans of the three patterns, ordered by start and then by kind as listed."""
    def long_value(span: Column) -> Column:
        return F.length(F.regexp_extract(span["text"], "^" + ASSIGN, 2)) >= LEAST_VALUE

    assign = _of_kind(F.filter(found(text, ASSIGN, ASSIGN_HINT), long_value), "assign")
    return F.concat(assign, _of_kind(found(text, ACCESS), "access"), _of_kind(found(text, HEX), "hex"))


def _in_order(spans: Column) -> Column:
    listed = F.lit(list(KINDS))
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.array_position(listed, s["kind"]).alias("rank"), s["end"].alias("end"),
            s["kind"].alias("kind"), s["text"].alias("text"),
        ),
    )
    return F.array_sort(keyed)


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _codes() -> Column:
    number = {c: i + 1 for i, c in enumerate(SYMBOLS)}
    return F.split(F.lit(" ".join(str(number.get(chr(i), 0)) for i in range(128))), " ").cast("array<int>")


def _symbols(token: Column) -> Column:
    """The numbers of a token's characters, after a 0 for the start."""
    return F.concat(F.array(F.lit(0)), F.transform(F.split(token, ""), lambda c: F.get(_codes(), F.ascii(c))))


def _pairs(token: Column) -> Column:
    """Numbers of the pairs of neighbouring characters."""
    return let(
        _symbols(token),
        lambda s: F.transform(F.sequence(F.lit(1), F.size(s) - 1), lambda i: F.get(s, i - 1) * _N + F.get(s, i)),
    )


def _identifiers(words: Column) -> Column:
    """Identifiers in the usual styles, each from three words that follow each other."""

    def spelled(i: Column) -> Column:
        a, b, c = (F.lower(F.get(words, i + k)) for k in range(3))
        number = (F.floor(i / 3) % 100).cast("string")
        styles = [
            F.concat(a, F.initcap(b), F.initcap(c)),
            F.concat_ws("_", a, b, c),
            F.concat(F.initcap(a), F.initcap(b), F.initcap(c)),
            F.concat_ws("-", a, b, c),
            F.concat(F.lit("/"), F.concat_ws("/", a, b, c)),
            F.upper(F.concat_ws("_", a, b, c)),
            F.concat(a, F.upper(F.substring(b, 1, 4)), F.initcap(c)),
            F.concat(a, number, F.lit("/"), b, F.lit("-"), c),
            F.concat(F.initcap(a), F.initcap(b), F.upper(F.substring(c, 1, 4)), number),
            F.concat(a, F.lit("="), b, F.lit("+"), c),
            F.concat(a, F.lit("-20"), F.lpad(number, 2, "0"), F.lit("-"), F.lpad(number, 2, "0"), F.lit("_"), b, c),
        ]
        style = F.floor(i / 3) % len(styles)
        chosen = F.when(style == 0, styles[0])
        for k, text in enumerate(styles[1:], 1):
            chosen = chosen.when(style == k, text)
        return chosen

    return F.when(F.size(words) >= 3, F.transform(F.sequence(F.lit(0), F.size(words) - 3, F.lit(3)), spelled))


def labelled_tokens(docs: DataFrame) -> DataFrame:
    """(label, token) of all texts: 1 for what the patterns find, 0 for words and identifiers made of them."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    base = base_spans(F.col("text"))
    value = lambda s: F.when(
        s["kind"] == "assign", F.regexp_extract(s["text"], "^" + ASSIGN, 2)
    ).otherwise(s["text"])
    hits = texts.where(F.col("text").rlike(f"{ACCESS}|{HEX}"))
    random = hits.select(
        F.lit(1).alias("label"), F.explode(F.array_distinct(F.transform(base, value))).alias("token")
    )
    rest = F.regexp_replace(F.regexp_replace(F.col("text"), ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    # runs of letters with none and no digit beside them, so no parts of codes
    words = F.regexp_extract_all(rest, F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z]{2,}(?![A-Za-z0-9+/_=-])"), F.lit(0))
    plain = let(
        F.array_distinct(words),
        lambda w: F.concat(
            F.filter(w, lambda x: F.length(x) >= 8),
            F.coalesce(_identifiers(w), F.array().cast("array<string>")),
        ),
    )
    ordinary = texts.select(F.lit(0).alias("label"), F.explode(plain).alias("token"))
    return random.unionByName(ordinary)


def _pair_numbers(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs of neighbouring characters of a batch's tokens, and where each token's begin.

    The tokens come from the patterns, so their characters are single bytes.
    """
    tokens = tokens.cast(pa.large_string()).drop_null()
    starts = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset : tokens.offset + len(tokens) + 1]
    if not len(tokens) or starts[0] == starts[-1]:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    number = np.zeros(256, np.int64)
    number[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(1, _N)
    codes = number[np.frombuffer(tokens.buffers()[2], np.uint8)[starts[0] : starts[-1]]]
    starts = np.unique(starts - starts[0])  # an empty token has no pair
    before = np.roll(codes, 1)
    before[starts[:-1]] = 0
    return before * _N + codes, starts


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, pair, n) of a task's tokens: what `pair_counts` has to give, which the tests hold against it."""
    counts = np.zeros((2, _N * _N), np.int64)
    for batch in batches:
        labels = batch.column("label")
        for label in (0, 1):
            pairs, _ = _pair_numbers(batch.column("token").filter(pc.equal(labels, label)))
            counts[label] += np.bincount(pairs, minlength=_N * _N)
    label, pair = counts.nonzero()
    yield pa.RecordBatch.from_arrays(
        [pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(counts[label, pair])], ["label", "pair", "n"]
    )


def pair_counts(tokens: DataFrame) -> dict[tuple[int, int], int]:
    """How often each pair of neighbouring characters occurs in the tokens, by label and the pair's number.

    The rows that reach the driver are different pairs of characters, as signs without a number share 0.
    """
    number = {c: i + 1 for i, c in enumerate(SYMBOLS)}
    # a line feed stands for the start; each match is empty, so pairs overlap
    pairs = F.regexp_extract_all(F.concat(F.lit("\n"), "token"), F.lit("(?s)(?=(..))"), F.lit(1))
    counts: dict[tuple[int, int], int] = {}
    for r in tokens.select("label", F.explode(pairs).alias("pair")).groupBy("label", "pair").count().collect():
        key = (r["label"], number.get(r["pair"][0], 0) * _N + number.get(r["pair"][1], 0))
        counts[key] = counts.get(key, 0) + r["count"]
    return counts


def ratios_of(tokens: DataFrame) -> list[float]:
    """The log-likelihood ratio of each pair of characters, random over ordinary.

    The driver gets some 68 * 68 counts per class. Half of the random model is learned, the
    other half gives all characters alike, since keys of another alphabet than the known ones
    are random too. Without tokens of a class its learned part is uniform.
    """
    counts = pair_counts(tokens)
    of_row = [[sum(counts.get((label, r * _N + k), 0) for k in range(_N)) for r in range(_N)] for label in (0, 1)]

    def share(label: int, pair: int) -> float:
        return (counts.get((label, pair), 0) + 0.5) / (of_row[label][pair // _N] + 0.5 * _N)

    return [
        round(
            math.log(UNIFORM / _N + (1 - UNIFORM) * share(1, p))
            - math.log(ORDINARY_UNIFORM / _N + (1 - ORDINARY_UNIFORM) * share(0, p)),
            6,
        )
        for p in range(_N * _N)
    ]


def train(docs: DataFrame) -> list[float]:
    """The ratios learned from `docs`."""
    return ratios_of(labelled_tokens(docs))


def _score(token: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio per character."""
    ratio = F.split(F.lit(" ".join(map(str, ratios))), " ").cast("array<double>")
    return F.aggregate(_pairs(token), F.lit(0.0), lambda a, p: a + F.get(ratio, p)) / F.length(token)


def margin_of(tokens: DataFrame, ratios: list[float]) -> float:
    """The threshold: `MARGIN`, or more where too many ordinary tokens of the length scanned pass it."""
    ordinary = tokens.where((F.col("label") == 0) & F.col("token").rlike(f"^{TOKEN}$"))
    tail = ordinary.agg(F.percentile_approx(_score(F.col("token"), ratios), 1 - FALSE_ALARMS, 10_000).alias("q"))
    return max(MARGIN, tail.first()["q"] or MARGIN)


def random_spans(text: Column, ratios: list[float], margin: float = MARGIN) -> Column:
    """Tokens of which the random model is likelier by more than `margin` per character."""

    def odd(span: Column) -> Column:
        token = span["text"]
        varied = F.size(F.array_distinct(F.split(token, ""))) >= LEAST_DISTINCT
        named = token.rlike("[A-Za-z]") & ~token.rlike(UUID)
        return F.when(varied & named, _score(token, ratios) > margin).otherwise(False)

    return _of_kind(F.filter(found(text, TOKEN), odd), "random")


def scan(docs: DataFrame, ratios: list[float] | None = None, margin: float | None = None) -> DataFrame:
    """`docs` with base_spans and spans: arrays of (start, rank, end, kind, text).

    Base spans come from the patterns; spans holds them and the random tokens that touch none of
    them. A null or empty text has none. Repeated rows are scanned one by one; an empty table
    gives an empty table. Columns of `docs` with the names of the outputs are replaced.
    Without `ratios` the models are learned from `docs`, and without `margin` it is set on the same tokens.
    """
    if ratios is None:
        tokens = stored(labelled_tokens(docs), "labelled-tokens")
        ratios = ratios_of(tokens)
        margin = margin_of(tokens, ratios) if margin is None else margin
    margin = MARGIN if margin is None else margin
    kept = without(docs, "base_spans", "spans")
    text = F.coalesce(F.col("text"), F.lit(""))
    based = kept.withColumn("base_spans", _in_order(base_spans(text)))

    def apart(span: Column) -> Column:
        return ~F.exists("base_spans", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))

    more = F.filter(random_spans(text, ratios, margin), apart)
    own = [quoted(c) for c in kept.columns]
    return based.select(*own, "base_spans", more.alias("_more")).select(
        *own, "base_spans", _in_order(F.concat(F.transform("base_spans", lambda s: s.dropFields("rank")), "_more")).alias("spans")
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by a placeholder."""

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(fresh, F.concat(acc["out"], before, F.lit(PLACEHOLDER))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    number = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(digest(F.col("base_spans")), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"),
    )


QUERIES = {"op9_secret_scan": op9_secret_scan}
ORACLE: dict[str, str] = {}
