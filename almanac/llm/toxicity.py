"""Toxicity of texts after undoing character tricks.

Noisy channel: the writer meant a word, and the channel replaced letters by look-alikes, put
signs or blanks between them or repeated them. The restored word is the likeliest path through the
lattice of what each character may stand for, found by Viterbi under a character trigram
model. The model is counted over all texts of the corpus, so it knows the corpus's own words.
Tokens of plain letters have one path and are taken as they are.

Scores: every restored word, and its first four and five letters, carries the share of
toxic documents among the labelled ones that hold it; a document's score joins the shares of
its words as independent evidence. Near copies (the components of `superminhash`) count once on
either side, so the words of a copied text do not turn into evidence. The classes are sampled at
different rates, which the shares undo; and of many rare words some stand in toxic documents by
chance, so a word has to do so more often than the best of as many meaningless ones would.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import crc32_mod, quoted, stored, table, without
from almanac.llm.shingles import groups
from almanac.llm.superminhash import near_duplicates

# Labelled documents per class from which the shares are learned.
SAMPLE = {1: 6_000, 0: 12_000}
# Files at most in which the sample is kept with its components.
SAMPLE_FILES = 16
HELD_OUT = 5
# Documents without toxicity that are added to each share's denominator.
CAUTION = 5.0
LEAST_SHARE = 0.5
# Four letters begin many harmless words too, so they have to tell more.
LEAST_SHARE_OF_FOUR = 0.8
LEAST_DOCS = 2
# Meaningless features that may be expected to pass for telling ones.
BY_CHANCE = 1.0
# Characters, with some for the record itself, that a task remembers of tokens it has read.
REMEMBERED = 8_000_000
THRESHOLD = 0.5
OUTPUTS = ("score", "predicted")

# What a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "+": "t", "|": "il", "(": "c", "€": "e", "£": "l",
}
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
_K = len(_LETTERS) + 2  # 0: no letter, last: any other letter
_CODE = {c: i + 1 for i, c in enumerate(_LETTERS)}
_TABLE = np.array(
    [_CODE.get(chr(c).lower(), _K - 1 if chr(c).isalpha() else 0) for c in range(0x250)] + [_K - 1], np.int64
)
_RUN = re.compile(r"(.)\1\1")
_SIGNS = "".join(c for c in LOOKALIKES if not c.isdigit())
_ONE = rf"[\w{re.escape(_SIGNS)}]"
_SPACED = re.compile(rf"(?<!\S){_ONE}(?:\s{_ONE}){{2,}}(?!\S)")
# Signs at the ends that stand for no letter.
_END = rf"(?:(?![{re.escape(_SIGNS)}])[\W_])+"
_ENDS = re.compile(rf"^{_END}|{_END}$")
# Cost of taking a token without letters as a number or as signs: for the token and for each character.
_LITERAL, _LITERAL_DIGIT, _LITERAL_SIGN, _LITERAL_MONEY = 2.0, 2.5, 2.0, 5.0


def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the letter trigrams of all texts of one task; runs of other characters are one blank."""
    counts = np.zeros(_K**3, np.int64)
    for batch in batches:
        for text in (value.as_py() for value in batch.column(0)):
            if not text:
                continue
            points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
            codes = np.concatenate([[0, 0], _TABLE[np.minimum(points, 0x250)], [0]])
            keep = np.ones(len(codes), bool)
            keep[2:] = (codes[2:] != 0) | (codes[1:-1] != 0)
            codes = codes[keep]
            grams = (codes[:-2] * _K + codes[1:-1]) * _K + codes[2:]
            if len(grams) < 4096:
                np.add.at(counts, grams, 1)
            else:
                counts += np.bincount(grams, minlength=_K**3)
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["gram", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """-log P(c | a, b) for all letters, from every text; at most 61 ** 3 counts reach the driver."""
    grams = docs.select(F.col("text").cast("string")).mapInArrow(count_trigrams, "gram bigint, n bigint")
    rows = grams.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(_K**3)
    counts[rows["gram"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    three = counts.reshape(_K, _K, _K)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 0.5) / (one.sum() + 0.5 * _K)
    p2 = (two + 20 * p1) / (two.sum(axis=1, keepdims=True) + 20)
    p3 = (three + 5 * p2[None]) / (three.sum(axis=2, keepdims=True) + 5)
    return -np.log(p3).astype(np.float32)


def options(token: str) -> list[list[tuple[str, float]]]:
    """What each character may stand for, with the channel's cost; an empty string deletes it."""
    out: list[list[tuple[str, float]]] = []
    ends = {c: len(token.rstrip(c)) for c in "!|"}
    begin = len(token) - len(token.lstrip("("))
    for i, c in enumerate(token):
        run = 1
        while i + run < len(token) and token[i + run] == c and run < 3:
            run += 1
        back = 1
        while i - back >= 0 and token[i - back] == c and back < 3:
            back += 1
        repeated = run + back - 1 >= 3
        if c.isalpha():
            out.append([(c, 1.0), ("", 0.2)] if repeated and back > 1 else [(c, 0.0)])
        elif c in LOOKALIKES:
            drop = 8.0 if c.isdigit() else 3.0
            # exclamation marks and bars end words, and brackets begin them
            if 0 < ends.get(c, 0) <= i or (c == "(" and i < begin):
                drop = 0.5
            out.append([*((x, 0.7) for x in LOOKALIKES[c]), ("", drop), (" ", drop)])
        elif c.isspace():
            out.append([("", 0.3), (" ", 1.0)])
        else:
            # letters set apart one by one are rather one word
            alone = (i < 2 or not token[i - 2].isalnum()) and (i + 2 >= len(token) or not token[i + 2].isalnum())
            out.append([("", 0.3), (" ", 3.0 if alone else 0.5)])
    return out


def restore(token: str, model: np.ndarray) -> str:
    """The likeliest reading of a token: Viterbi over pairs of letters."""
    return _best(token, model)[1]


def _literal(token: str) -> float:
    """The cost of a token without letters that means no word."""
    each = lambda c: _LITERAL_DIGIT if c.isdigit() else _LITERAL_MONEY if c in "@$€£" else _LITERAL_SIGN
    return _LITERAL + sum(0.3 if c.isspace() else each(c) for c in token)


def _best(token: str, model: np.ndarray) -> tuple[float, str]:
    # state: the last two letters -> (cost, letters so far as a chain)
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for choices in options(token):
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, chain) in states.items():
            row = model[a, b]
            for letter, price in choices:
                if letter == "":
                    state, total, grown = (a, b), cost + price, chain
                else:
                    c = 0 if letter == " " else _CODE.get(letter, _K - 1)
                    if c == 0 and b == 0:
                        state, total, grown = (a, b), cost + price, chain
                    else:
                        state, total, grown = (b, c), cost + price + float(row[c]), (letter, chain)
                if state not in after or total < after[state][0]:
                    after[state] = (total, grown)
        states = after
    least, _, chain = min(
        (cost + float(model[a, b, 0]), n, chain) for n, ((a, b), (cost, chain)) in enumerate(states.items())
    )
    letters = []
    while chain:
        letters.append(chain[0])
        chain = chain[1]
    return least, "".join(reversed(letters))


class Memo(dict):
    """What tokens mean, forgotten when the tokens have more than `REMEMBERED` characters."""

    chars = 0

    def keep(self, token: str, meaning: tuple) -> tuple:
        self.chars += len(token) + 50
        if self.chars > REMEMBERED:
            self.clear()
            self.chars = len(token) + 50
        self[token] = meaning
        return meaning


class Restorer:
    """Words of a text with the tricks undone; remembers what tokens mean."""

    def __init__(self, model: np.ndarray):
        self._model = model
        self._known = Memo()

    def _read(self, token: str) -> tuple[str, ...]:
        core = _ENDS.sub("", token)
        if core.isalpha() and not _RUN.search(core):
            return (core,)
        lettered = any(c.isalpha() for c in core)
        if not lettered and not any(c in LOOKALIKES for c in core):
            return ()
        cost, read = _best(core, self._model)
        if not lettered and cost >= _literal(core):
            return ()
        return tuple(w for w in read.split(" ") if w)

    def tokens(self, text: str) -> set[str]:
        low = text.lower()
        found = set(low.split())
        for match in _SPACED.finditer(low):
            found.add(" ".join(match[0].split()))
        return found

    def read(self, token: str) -> tuple[str, ...]:
        words = self._known.get(token)
        return self._known.keep(token, self._read(token)) if words is None else words

    def words(self, text: str) -> set[str]:
        return {word for token in self.tokens(text) for word in self.read(token)}


def features(word: str) -> tuple[str, ...]:
    """The word itself and, marked by a stroke, its first four and five letters."""
    return (word, word[:4] + "-", word[:5] + "-") if len(word) >= 4 else (word,)


def _evidence(model: np.ndarray, wanted: set[str] | None = None) -> Callable:
    """The features of the texts, those wanted if given, each with the components that hold it; per group of texts
    without repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Restorer(model)
        for batch in batches:
            for first, texts in groups(batch.column(0)):
                found: set[tuple[str, int]] = set()
                for text, component in zip(texts, batch.column(1).slice(first, len(texts))):
                    own = {f for word in reader.words(text.as_py() or "") for f in features(word)}
                    number = component.as_py()
                    found.update((f, number) for f in (own if wanted is None else own & wanted))
                rows = list(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())],
                    ["feature", "value"],
                )

    return run


def _learnable(labels: DataFrame) -> DataFrame:
    """(_id, toxic) of the labelled documents that may be learned from."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(crc32_mod(F.col("doc_id"), HELD_OUT) != 0)
    return known.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))


def _sample(docs: DataFrame, labels: DataFrame, sample: dict[int, int]) -> DataFrame:
    """(text, toxic) of at most `sample` labelled documents per class that may be learned from."""
    one = _learnable(labels)
    parts = [
        one.where(F.col("toxic") == toxic).orderBy(F.xxhash64("_id"), "_id").limit(n) for toxic, n in sample.items()
    ]
    # at most sum(sample) ids, so they go to the texts
    ids = stored(parts[0].unionByName(parts[1]), "sample-ids")
    joined = docs.select(F.col("doc_id").alias("_doc"), "text").join(F.broadcast(ids), F.col("_doc") == F.col("_id"))
    return joined.select("text", "toxic")


def _clean_weight(labels: DataFrame, sample: dict[int, int]) -> float:
    """How many times as many clean documents as toxic ones a sampled document stands for."""
    known = {r["toxic"]: r["count"] for r in _learnable(labels).groupBy("toxic").count().collect()}
    each = {toxic: max(1.0, known.get(toxic, 0) / n) if n else 1.0 for toxic, n in sample.items()}
    return each[0] / each[1]


def _beyond_chance(toxic: float, clean: float, rate: float, tried: int) -> bool:
    """Whether at most `BY_CHANCE` of `tried` meaningless features would be in so many toxic documents among
    those that hold them, if documents are toxic at this rate (Chernoff's bound of the binomial tail).

    Where most labelled documents are toxic, the rate is one half, as beyond it a word need tell nothing to be right.
    """
    share = toxic / (toxic + clean)
    rate = min(rate, 0.5)
    if share <= rate:
        return False
    surprise = toxic * math.log(share / rate)
    if clean:
        surprise += clean * math.log((1 - share) / (1 - rate))
    return surprise >= math.log(tried / BY_CHANCE)


def train(docs: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE) -> tuple[np.ndarray, dict[str, float]]:
    """The character model and the toxic share of each telling feature.

    Without labels, or without toxic ones, no feature tells and every score is 0.
    """
    model = language_model(docs)
    numbered = _sample(docs, labels, sample).withColumn("number", F.monotonically_increasing_id())
    rows = stored(numbered, "sample")  # fixes the row numbers
    groups = near_duplicates(rows.select(F.col("number").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("number"), "component_id"
    )
    rows = rows.join(groups, "number").select("text", "component_id", "toxic")
    rows = stored(rows, "sample-groups", files=SAMPLE_FILES)
    schema = "feature string, value bigint"

    def evidence(label: int, wanted: set[str] | None = None) -> DataFrame:
        texts = rows.where(F.col("toxic") == label).select("text", "component_id")
        found = texts.mapInArrow(_evidence(model, wanted), schema)
        return found.groupBy("feature").agg(F.count_distinct("value").alias("n"))

    seen = evidence(1).where(F.col("n") >= LEAST_DOCS).toPandas()
    shares = dict(zip(seen["feature"], seen["n"].astype(float)))
    counts = evidence(0, set(shares)).toPandas()
    against = dict(zip(counts["feature"], counts["n"].astype(float)))
    texts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count_distinct("component_id").alias("n")).collect()}
    rate = texts.get(1, 0) / max(1, sum(texts.values()))
    weight = _clean_weight(labels, sample)
    least = lambda f: LEAST_SHARE_OF_FOUR if len(f) == 5 and f[4] == "-" else LEAST_SHARE
    telling = {}
    for feature, t in shares.items():
        clean = against.get(feature, 0.0)
        share = t / (t + weight * clean + CAUTION)
        if share >= least(feature) and _beyond_chance(t, clean, rate, len(shares)):
            telling[feature] = share
    return model, telling


def _scorer(model: np.ndarray, shares: dict[str, float]) -> Callable:
    """A function of the text column alone: the other columns stay with Spark, and a batch of texts is read
    one by one."""

    def telling(reader: Restorer, token: str) -> tuple[tuple[str, float], ...]:
        out = []
        for word in reader._read(token):
            share = max(shares.get(f, 0.0) for f in features(word))
            if share:
                out.append((word, share))
        return tuple(out)

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader, of_token = Restorer(model), Memo()

        def score(text: str) -> float:
            hits: dict[str, float] = {}
            for token in reader.tokens(text):
                got = of_token.get(token)
                if got is None:
                    got = of_token.keep(token, telling(reader, token))
                if got:
                    hits.update(got)
            rest = 1.0
            for word in sorted(hits):
                rest *= 1.0 - hits[word]
            return 1.0 - rest

        for batch in batches:
            found = np.zeros(len(batch))
            for i, text in enumerate(batch):
                found[i] = score(text.as_py() or "")
            yield pa.array(found)

    return F.arrow_udf(scores, "double")


def score_texts(
    docs: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE, keep_text: bool = True
) -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 from 0.5 on).

    A null or empty text scores 0. Repeated rows are scored one by one; an empty table gives an
    empty table. Columns with the names of the outputs are replaced.
    """
    model, shares = train(docs, labels, sample)
    kept = without(docs, *OUTPUTS) if keep_text else without(docs, *OUTPUTS, "text")
    score = _scorer(model, shares)(F.col("text").cast("string"))
    scored = docs.select(*[quoted(c) for c in kept.columns], score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(docs, table(spark, sf_dir, "labels"), keep_text=False)
    return scored.select("doc_id", (crc32_mod(F.col("doc_id"), HELD_OUT) == 0).alias("held_out"), "score", "predicted")


QUERIES = {"op2_toxicity": op2_toxicity}
ORACLE: dict[str, str] = {}
