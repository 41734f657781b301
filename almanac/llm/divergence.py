"""Quality rules from distribution divergence.

Each language gets two reference distributions from its documents: character classes and
common words. A document is compared with every language by the Jensen-Shannon distance of
both histograms, and fails when even the nearest language is too far. Texts
below a least length are not judged, as their histograms say little.

The references are counts over all documents, at most a few hundred numbers per language.
A common word is one that makes up at least `COMMON` of its language's words, so there are at
most 1 / COMMON of them. Everything else stays in the row of its document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import SPACE, let, quoted, stored, table, without, words

CLASSES = {
    "lower": r"[a-z]",
    "upper": r"[A-Z]",
    "other_letter": r"[\p{L}&&[^a-zA-Z]]",
    "digit": r"\p{N}",
    "sentence": r"[.,;:!?'\"()-]",
    "symbol": r"[#*$%&|<>@=+/_\\~^{}\[\]]",
}
COMMON = 0.004
LEAST_WORDS = 50
LEAST_CHARS = 200
# Largest Jensen-Shannon distances (0 to 1) from the nearest language.
MOST_CLASSES = 0.3
MOST_WORDS = 0.36
OUTPUTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "nearest", "class_distance", "word_distance", "kept",
)


def repeat_words(of: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""

    def windows(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(w) - 2)
        return F.transform(places, lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))

    def covered(hashes: Column) -> Column:
        # sorted by hash, equal windows are neighbours
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda p: let(twice(p), gaps))

    def twice(p: Column) -> Column:
        def again(x: Column, k: Column) -> Column:
            same = lambda j: F.coalesce(F.get(p, j)["h"] == x["h"], F.lit(False))
            return same(k - 1) | same(k + 1)

        return F.array_sort(F.transform(F.filter(p, again), lambda x: x["i"]))

    def gaps(at: Column) -> Column:
        # each window adds the words that the one before it did not reach
        added = F.transform(at, lambda i, k: F.least(F.lit(3), F.coalesce(i - F.get(at, k - 1), F.lit(3))))
        return F.aggregate(added, F.lit(0), lambda a, x: a + x)

    def count(hashes: Column) -> Column:
        repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeated, covered(hashes)).otherwise(0)

    return F.when(F.size(of) < 3, 0).otherwise(let(windows(of), count)).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def base_figures(text: Column, of: Column) -> dict[str, Column]:
    squeezed = F.regexp_replace(text, SPACE, "")
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return {
        "n_words": F.size(of).cast("long"),
        "word_chars": F.length(squeezed).cast("long"),
        "n_symbols": symbols.cast("long"),
        "n_dup_lines": let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(of),
    }


def class_counts(text: Column) -> Column:
    """Array of the characters per class; the classes do not overlap, others are left out.

    Each class is taken out of what the ones before it left, so the later ones, which are
    rare, look at short texts.
    """

    def taken(rest: Column, patterns: list[str], counts: list[Column]) -> Column:
        if not patterns:
            return F.array(*counts)
        without_class = F.regexp_replace(rest, patterns[0] + "+", "")
        return let(
            without_class, lambda left: taken(left, patterns[1:], [*counts, F.length(rest) - F.length(left)])
        )

    return let(text, lambda t: taken(t, list(CLASSES.values()), []))


def references(docs: DataFrame, common: float = COMMON) -> dict[str, dict]:
    """Per language: shares of the character classes, and of its common words.

    Null languages teach nothing. What comes to the driver is bounded: seven sums and at most
    1 / `common` words per language. Shares are of all words of the language, also those seen once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    given = docs.where(F.col("lang").isNotNull()).select("lang", text.alias("text"))
    counted = given.select(
        "lang", class_counts(F.col("text")).alias("counts"), F.size(words(F.col("text"))).alias("n_words")
    )
    sums = [F.sum(F.get("counts", F.lit(i))).alias(k) for i, k in enumerate(CLASSES)]
    per_language = stored(counted.groupBy("lang").agg(*sums, F.sum("n_words").alias("total")), "language-sums")
    classes = per_language.collect()
    split = given.select("lang", F.explode(F.split(F.lower("text"), SPACE)).alias("word"))
    each = split.where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    totals = per_language.select("lang", "total")
    frequent = each.join(F.broadcast(totals), "lang").where(F.col("n") >= common * F.col("total"))
    out: dict[str, dict] = {}
    for row in classes:
        total = sum(row[k] for k in CLASSES) or 1
        out[row["lang"]] = {"classes": [row[k] / total for k in CLASSES], "words": {}}
    for row in frequent.collect():
        out[row["lang"]]["words"][row["word"]] = row["n"] / row["total"]
    return out


def _half(p: Column, q: Column) -> Column:
    """p log2(p / m), m the mean of both; 0 where p is 0."""
    return F.when(p > 0, p * F.log2(2.0 * p / (p + q))).otherwise(0.0)


def class_distance(counts: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance of the class histogram (an array of counts) from a reference."""
    total = F.aggregate(counts, F.lit(0), lambda a, c: a + c)

    def distance(n: Column) -> Column:
        terms = F.transform(
            counts, lambda c, i: F.struct((c / n).alias("p"), F.get(F.lit(reference), i).alias("q"))
        )
        parts = F.aggregate(terms, F.lit(0.0), lambda a, t: a + _half(t["p"], t["q"]) + _half(t["q"], t["p"]))
        return F.sqrt(F.greatest(parts / 2.0, F.lit(0.0)))

    return F.when(total == 0, 1.0).otherwise(let(total, distance))


def word_distance(tally: Column, n_words: Column, reference: dict[str, float]) -> Column:
    """Jensen-Shannon distance of the common-word histogram from a reference.

    `tally` holds (word, n) of the document's words that are common in any language; all words
    that are not common in this language share one bin.
    """
    if not reference:
        return F.lit(1.0)
    listed, shares = list(reference), list(reference.values())
    rest = max(0.0, 1.0 - sum(shares))

    def placed(t: Column) -> Column:
        return F.struct(
            (t["n"] / n_words).alias("p"), F.get(F.lit(shares), F.array_position(F.lit(listed), t["word"]).cast("int") - 1).alias("q")
        )

    own = F.filter(F.transform(tally, placed), lambda t: t["q"].isNotNull())
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))

    def step(a: Column, t: Column) -> Column:
        both = _half(t["p"], t["q"]) + _half(t["q"], t["p"])
        return F.struct((a["sum"] + both).alias("sum"), (a["p"] + t["p"]).alias("p"), (a["q"] + t["q"]).alias("q"))

    def finish(a: Column) -> Column:
        p, q = F.greatest(1.0 - a["p"], F.lit(0.0)), F.lit(rest)
        # a word of the reference that the document lacks adds its own share
        missing = F.greatest(F.lit(sum(shares)) - a["q"], F.lit(0.0))
        return F.sqrt(F.greatest((a["sum"] + _half(p, q) + _half(q, p) + missing) / 2.0, F.lit(0.0)))

    return F.aggregate(own, start, step, finish)


def tally(of: Column, listed: list[str]) -> Column:
    """(word, n) for the words of an array that are in a list."""

    def counted(s: Column) -> Column:
        def one(word: Column, k: Column, distinct: Column) -> Column:
            begin = F.array_position(s, word)
            after = F.coalesce(F.array_position(s, F.get(distinct, k + 1)), F.size(s) + 1)
            return F.struct(word.alias("word"), (after - begin).alias("n"))

        return let(F.array_distinct(s), lambda d: F.transform(d, lambda w, k: one(w, k, d)))

    if not listed:
        return F.array().cast("array<struct<word:string,n:bigint>>")
    return let(F.sort_array(F.filter(of, lambda w: w.isin(listed))), counted)


def judge(docs: DataFrame, refs: dict[str, dict] | None = None) -> DataFrame:
    """`docs` with the figures, the nearest language and the verdict.

    base_failed: fewer than 50 words, or over half of the words in repeated windows.
    kept: not base_failed, and near enough to some language in both histograms; texts under
    the least length, and all texts when no language is known, pass that part. A null text
    counts as empty and fails. Repeated rows are judged one by one, an empty table
    gives an empty table, columns with the names of the outputs are replaced.
    """
    refs = references(docs) if refs is None else refs
    kept = without(docs, *OUTPUTS, "_text", "_words", "_low", "_tally", "_classes", "_best")
    own = [quoted(c) for c in kept.columns]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = kept.select("*", text.alias("_text")).withColumn("_words", words(F.col("_text")))
    figures = base_figures(F.col("_text"), F.col("_words"))
    listed = sorted({w for r in refs.values() for w in r["words"]})
    measured = rows.select(
        *own,
        *[c.alias(k) for k, c in figures.items()],
        tally(F.transform("_words", lambda w: F.lower(w)), listed).alias("_tally"),
        class_counts(F.col("_text")).alias("_classes"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    compared = [
        F.struct(
            F.lit(lang).alias("lang"),
            class_distance(F.col("_classes"), r["classes"]).alias("classes"),
            word_distance(F.col("_tally"), F.col("n_words"), r["words"]).alias("words"),
        )
        for lang, r in sorted(refs.items())
    ]
    long_enough = (F.col("n_words") >= LEAST_WORDS) & (F.col("word_chars") >= LEAST_CHARS)
    if not compared:
        best = F.lit(None).cast("struct<sum:double,lang:string,classes:double,words:double>")
    else:
        scored = F.transform(
            F.array(*compared),
            lambda c: F.struct(
                (c["classes"] / MOST_CLASSES + c["words"] / MOST_WORDS).alias("sum"), c["lang"].alias("lang"),
                c["classes"].alias("classes"), c["words"].alias("words"),
            ),
        )
        best = F.when(long_enough, F.array_min(scored))
    far = (F.col("_best.classes") > MOST_CLASSES) | (F.col("_best.words") > MOST_WORDS)
    return (
        measured.withColumn("base_failed", failed)
        .withColumn("_best", best)
        .select(
            *own,
            *figures,
            "base_failed",
            F.col("_best.lang").alias("nearest"),
            F.col("_best.classes").alias("class_distance"),
            F.col("_best.words").alias("word_distance"),
            (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"),
        )
    )


def op6_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select("doc_id", *[c for c in OUTPUTS])


QUERIES = {"op6_distribution_divergence": op6_distribution_divergence}
ORACLE: dict[str, str] = {}
