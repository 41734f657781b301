"""Spelling variants: words one edit apart, found by walking tries level by level.

The tries are relations. An edge is (trie, path, label): `path` is the node, the letters from
the root; `label` the next letters below it. A state is (trie, path, text, edits): a word on
its way down, with none or one edit spent. One step joins all states with the edges of their
level; what comes out are the states of the next level. A state at the end of its trie has
found a word one edit away.

Two words one edit apart agree outside the edit, so the edit lies in the last third, the first
third or the middle of the words. Each case has its own tries, which start below the letters
that are known to agree, and no state has to branch near a root that all words share:

    0  edit in the last third    text read forwards, from two thirds on
    1  edit in the first third   text read backwards, from two thirds on
    2  edit in between           a trie per last third, from one third on

A trie holds the words of one length, so the length of a word and of its trie say which kind
of edit is left. Words of up to `LEVELS` letters go down letter by letter; longer ones take
several letters at a time, so the number of steps is bounded for words of any length.

Nodes that many states wait at are split: states are dealt over copies of the node's edges.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import CRC32_SQL, stored, table
from almanac.session import staging_path

LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LETTERS = 7
LEAST_COUNT = 2
FACTOR = 10
ONE_IN = 31
LEVELS = 32
# A node with more waiting states than this, and more than a thousandth of all, is split.
NODE_STATES = 10_000
_NODE = ["family", "size", "goal", "anchor", "path"]


def lowered(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are; text of ASCII takes the short way."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def planted_runs(docs: DataFrame) -> DataFrame:
    """The letter runs of all texts, one in `ONE_IN` by hash with a letter left out.

    Runs that stay shorter than `LEAST_LETTERS` are left out; a null text has none, a null id
    counts as empty text in the hash.
    """
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{LEAST_LETTERS},}}+"), F.lit(0))
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = docs.select(ident.alias("ident"), F.explode(runs).alias("run")).withColumn("run", lowered(F.col("run")))
    hashed = F.crc32(F.concat_ws(":", "ident", "run").cast("binary"))
    at = (F.col("hash") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("hash") % ONE_IN == 0, cut).otherwise(F.col("run"))
    return found.withColumn("hash", hashed).select(word.alias("word")).where(F.length("word") >= LEAST_LETTERS)


def counted(words: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """Distinct words (column `word`, null left out) and their counts n, those seen `least` times or more."""
    kept = words.where("word is not null")
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _stride(goal: Column) -> Column:
    return F.ceil(goal / LEVELS).cast("int")


def _reading(word: Column, size: Column, family: Column) -> tuple[Column, Column, Column]:
    """Anchor, text to walk and letters known to agree, for a word in tries of words of `size` letters."""
    third = F.floor(size / 3).cast("int")
    middle = family == 2
    anchor = F.when(middle, F.right(word, third)).otherwise("")
    rest = F.substring(word, F.lit(1), F.length(word) - third)
    text = F.when(family == 1, F.reverse(word)).when(middle, rest).otherwise(word)
    return anchor, text, F.when(middle, third).otherwise(size - third)


def edges(words: DataFrame) -> DataFrame:
    """All tries below the letters known to agree: level, family, goal, anchor, path, label, and n of the
    word that ends there. `goal` is the number of letters down to the end of the trie."""
    size = F.length("word")
    family = F.col("family")
    read = words.withColumn("family", F.explode(F.array(*map(F.lit, range(3)))))
    anchor, text, start = _reading(F.col("word"), size, family)
    read = read.select(
        "family", "n", size.alias("size"), anchor.alias("anchor"), text.alias("text"), start.alias("start")
    )
    stride, goal = _stride(F.col("size")), F.length("text")
    read = read.withColumns({"stride": stride, "goal": goal})
    last = F.ceil((F.col("goal") - F.col("start")) / F.col("stride")).cast("int") - 1
    steps = read.withColumn("level", F.explode(F.sequence(F.lit(0), last)))
    at = F.col("start") + F.col("level") * F.col("stride")
    ends = F.col("level") == last
    return (
        steps.select(
            "level", "family", "size", "goal", "anchor",
            F.substring("text", F.lit(1), at).alias("path"),
            F.substring("text", at + 1, F.col("stride")).alias("label"),
            F.when(ends, F.col("n")).alias("n"),
        )
        .groupBy("level", "family", "size", "goal", "anchor", "path", "label")
        .agg(F.max("n").alias("n"))
    )


def seeds(words: DataFrame, least: int) -> DataFrame:
    """Every word at the first node of each trie that could hold a word one edit away."""
    spread = words.select("word", F.explode(F.array(*map(F.lit, range(3)))).alias("family")).withColumn(
        "size", F.explode(F.array(*[F.length("word") + d for d in (-1, 0, 1)]))
    )
    anchor, text, start = _reading(F.col("word"), F.col("size"), F.col("family"))
    third = F.floor(F.col("size") / 3).cast("int")
    goal = F.when(F.col("family") == 2, F.col("size") - third).otherwise(F.col("size"))
    return spread.where(F.col("size") >= least).select(
        "family", "size", goal.alias("goal"), anchor.alias("anchor"),
        F.substring(text, F.lit(1), start).alias("path"), text.alias("text"), F.lit(0).alias("edits"),
    )


def _split(states: DataFrame, own: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """Deal the states of crowded nodes over copies of the nodes' edges."""
    limit = max(NODE_STATES, total // 1000)
    crowd = states.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("_crowd")).where(F.col("_crowd") > limit)
    # at most total / limit rows, so at most a thousand
    crowd = F.broadcast(crowd.select(*_NODE, F.ceil(F.col("_crowd") / limit).cast("int").alias("_copies")))
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    dealt = states.join(crowd, _NODE, "left").withColumn("_copy", F.pmod(F.xxhash64("text"), copies).cast("int"))
    copied = own.join(crowd, _NODE, "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.drop("_copies"), copied.drop("_copies")


def step(states: DataFrame, own: DataFrame, total: int) -> DataFrame:
    """Move all states one level down: along a label that the text has next, or one edit away from it.

    An edit is spent only where the label does not match as it is: what an earlier edit
    could reach, a later one reaches too.
    """
    dealt, copied = _split(states, own, total)
    met = dealt.join(copied, [*_NODE, "_copy"])
    ahead = F.when(F.col("family") == 2, F.length("text") - F.col("goal")).otherwise(F.length("text") - F.col("size"))
    at, width = F.length("path") + 1, F.length("label")
    same = F.substring("text", at, width) == F.col("label")
    shifted = F.substring("text", at + ahead, width) == F.col("label")
    near = F.substring("text", at, width + ahead)
    edited = (F.length(near) == width + ahead) & (F.levenshtein(near, F.col("label"), 1) == 1)
    after = F.when(F.col("edits") == 1, F.when(shifted, 1)).when(same, 0).when(edited, 1)
    moved = met.select(
        "family", "size", "goal", "anchor", F.concat("path", "label").alias("path"), "text", after.alias("edits"), "n"
    )
    # at the end of a trie of shorter words one letter may be left over, which is the edit
    spare = (F.col("edits") == 0) & (F.length("text") == F.col("goal") + 1)
    ended = F.length("path") == F.col("goal")
    return moved.where("edits is not null").where(~ended | (F.col("edits") == 1) | spare)


def _word(text: Column) -> Column:
    read = F.when(F.col("family") == 1, F.reverse(text)).when(F.col("family") == 2, F.concat(text, "anchor"))
    return read.otherwise(text)


def _first_found(size: Column) -> Column:
    """Whether no other family finds the pair too: last third before first third before middle."""
    third = F.floor(size / 3).cast("int")
    head = F.substring("word", F.lit(1), size - third) == F.substring("near", F.lit(1), size - third)
    tail = F.right(F.col("word"), size - third) == F.right(F.col("near"), size - third)
    return (
        F.when(F.col("family") == 0, True).when(F.col("family") == 1, ~head).otherwise(~head & ~tail)
    )


def near_words(words: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """All ordered pairs of words that differ by one inserted, deleted or replaced code point: word, near,
    and the count n of the near word. `words` are distinct, with `least` code points or more, at least 6."""
    spark = words.sparkSession
    path = staging_path(spark, "tries")
    every = edges(words)
    every.write.partitionBy("level").parquet(path)
    tries = spark.read.schema(every.schema).parquet(path)
    deepest = tries.agg(F.max("level")).first()[0]
    out = spark.createDataFrame([], "word string, near string, n bigint")
    if deepest is None:
        return out
    states = seeds(words, least)
    total = 9 * words.count()
    for level in range(deepest + 1):
        own = tries.where(F.col("level") == level).drop("level")
        states = stored(step(states, own, total), "states")
        ended = states.where(F.length("path") == F.col("goal"))
        found, near = _word(F.col("text")), _word(F.col("path"))
        pairs = ended.select(found.alias("word"), near.alias("near"), "n", "family", "size")
        out = out.unionByName(pairs.where(_first_found(F.col("size"))).select("word", "near", "n"))
        states = states.where(F.length("path") < F.col("goal")).drop("n")
        total = states.count()
        if not total:
            break
    return out


def roots(forms: DataFrame) -> DataFrame:
    """word and root: the last form reached from each word of `forms` (word, form).

    Counts grow by `FACTOR` along forms, so chains are short and have no circles; each round
    doubles the way walked.
    """
    walked = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = walked.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        joined = walked.join(ahead, "root", "left")
        moved = joined.select("word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("_moved"))
        moved = stored(moved, "roots")
        walked = moved.drop("_moved")
        if not moved.where("_moved").limit(1).count():
            return walked


def variants(words: DataFrame, least: int = LEAST_LETTERS, factor: int = FACTOR) -> DataFrame:
    """Per word its form, root and near words. `words` has distinct `word` and `n`.

    A word's form is its near word of largest n (ties: smallest in code-point order) if that is
    `factor` times its own n or more, else null; the root is the last form, or the word itself.
    """
    words = words.select("word", "n")
    pairs = near_words(words, least).withColumn("rank", F.struct((-F.col("n")).alias("n"), F.col("near").alias("near")))
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("rank").alias("best"))
    joined = words.join(best, "word", "left")
    frequent = -F.col("best.n") >= factor * F.col("n")
    found = stored(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, F.col("best.near")).alias("form"),
            F.when(frequent, -F.col("best.n")).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(stored(counted(planted_runs(docs)), "words"))


QUERIES = {"op11_spelling_variants": op11_spelling_variants}

_RUN = "coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run"
ORACLE = {
    "op11_spelling_variants": f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                           '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run
  FROM documents
),
grouped AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, {CRC32_SQL.format(text=_RUN)} AS h FROM grouped),
cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END
         AS word, n
  FROM hashed
),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
holes AS (SELECT word, n, i, substr(word, 1, i) AS head, substr(word, i + 2) AS tail FROM places),
near AS (
  SELECT a.word, b.word AS near, b.n FROM holes a JOIN holes b
    ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON b.word = a.head || a.tail
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON b.word = a.head || a.tail
),
best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n FROM near GROUP BY word
),
found AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 10 * words.n THEN near END AS form,
         CASE WHEN near_n >= 10 * words.n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
),
walk(word, last, steps) AS (
  SELECT word, word, 0 FROM found
  UNION ALL SELECT walk.word, found.form, steps + 1 FROM walk JOIN found ON walk.last = found.word
  WHERE found.form IS NOT NULL
),
ends AS (SELECT word, arg_max(last, steps) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM found JOIN ends USING (word)
"""
}
