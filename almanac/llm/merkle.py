"""Merkle fingerprints of documents.

The leaves are paragraphs: lines with their line feed, a line of more than 64 characters
counting as several. Those end where the text itself says so, after a blank that follows a vowel
or a sign, 33 to 96 characters on, so that a letter put in moves the next few ends only; a
stretch without such a place is cut at 96 characters. A section is a run of paragraphs that ends with one whose hash says
so (one in eight), so an inserted paragraph moves no later section border. A section's hash
covers its paragraphs' hashes, the root covers the sections. The fingerprint is text:
root, section hashes, paragraph hashes (the latter two cut to 12 digits).

Two texts are equal when their roots are; where they differ, the sections and then the
paragraphs that only one side has locate the edit. The likeness of two fingerprints is the
share of distinct paragraphs that both have (Dice).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm.common import let, table, without
from almanac.session import shuffle_width

PARAGRAPH = r"[^\n]{0,64}\n|[^\n]{31,94}?[.,;:!?aeiou]\x20|[^\n]{1,96}\n?"
BORDERS = ("0", "8")
# More buckets than this come from cutting the space between two bounds evenly.
BOUNDS = 256
# Numbers that a stretch of ids leaves for the stretches inside a hot id.
FINE = 1 << 16
# Copies of one row that a task puts out at a time.
COPIES_PER_TASK = 10_000


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; null counts as empty, which has a root and no branches."""
    given = F.coalesce(text, F.lit(""))
    hashes = F.transform(F.regexp_extract_all(given, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.sha2(p, 256))

    def tree(leaves: Column) -> Column:
        places = F.when(F.size(leaves) > 0, F.sequence(F.lit(1), F.size(leaves))).otherwise(
            F.array().cast("array<int>")
        )
        ends = F.filter(
            places,
            lambda i: (i == F.size(leaves)) | F.substring(F.element_at(leaves, i), 64, 1).isin(*BORDERS),
        )
        return let(ends, lambda e: let(sections(leaves, e), lambda s: joined(leaves, s)))

    def sections(leaves: Column, ends: Column) -> Column:
        def one(end: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
            return F.sha2(F.array_join(F.slice(leaves, before + 1, end - before), ""), 256)

        return F.transform(ends, one)

    def joined(leaves: Column, parts: Column) -> Column:
        short = lambda hashes: F.array_join(F.transform(hashes, lambda h: F.substring(h, 1, 12)), ".")
        return F.concat_ws("|", F.sha2(F.array_join(parts, ""), 256), short(parts), short(leaves))

    return let(hashes, tree)


def branches(print_: Column, level: int) -> Column:
    """The hashes of a fingerprint's sections (1) or paragraphs (2)."""
    part = F.split_part(print_, F.lit("|"), F.lit(level + 1))
    return F.when(part == "", F.array().cast("array<string>")).otherwise(F.split(part, "[.]"))


def likeness(one: Column, other: Column) -> Column:
    """Share of paragraphs two fingerprints have in common, 1 for equal ones."""

    def dice(a: Column, b: Column) -> Column:
        both = F.size(a) + F.size(b)
        return F.when(both == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)

    distinct = lambda p: F.array_distinct(branches(p, 2))
    return F.when(one == other, 1.0).otherwise(
        let(distinct(one), lambda a: let(distinct(other), lambda b: dice(a, b)))
    )


def changed(one: Column, other: Column) -> Column:
    """Numbers, from 0, of the paragraphs of `one` that are not in `other`; empty for equal roots."""
    same = F.split_part(one, F.lit("|"), F.lit(1)) == F.split_part(other, F.lit("|"), F.lit(1))

    def listed(a: Column, b: Column) -> Column:
        found = F.transform(a, lambda p, i: F.when(~F.array_contains(b, p), i))
        return F.filter(found, lambda i: i.isNotNull())

    return F.when(same, F.array().cast("array<int>")).otherwise(
        let(branches(one, 2), lambda a: let(branches(other, 2), lambda b: listed(a, b)))
    )


def _at_most(values: list[int], key: Column) -> Column:
    """How many of the ascending values are not above `key`; none are for null.

    A binary search, and `key` is worked out once per row: the values grow with the table.
    """
    if not values:
        return F.lit(0)
    all_values = F.array(*[F.lit(v).cast("long") for v in values])
    steps = F.lit([1 << i for i in reversed(range(len(values).bit_length()))])

    def search(k: Column) -> Column:
        step_up = lambda at, step: F.when(F.get(all_values, at + step - 1) <= k, at + step).otherwise(at)
        return F.aggregate(steps, F.lit(0), step_up)

    return let(key, search)


def _bucket(bounds: list[int], cuts: int) -> Column:
    """The stretch of ids a row belongs to; higher ids have higher numbers, null has 0."""
    if not bounds:
        return F.lit(0).cast("long")
    key, all_bounds = F.col("_id"), F.lit(bounds)

    def stretch(below: Column) -> Column:
        low = F.get(all_bounds, below - 1).cast("double")
        high = F.get(all_bounds, below).cast("double")
        # large ids round: two bounds may be the same double, and an id the bound above it
        part = F.floor(F.try_divide((key - low) * cuts, high - low)).cast("long")
        inside = F.coalesce(F.least(part, F.lit(cuts - 1)), F.lit(0))
        return F.coalesce((below * cuts + inside).cast("long"), F.lit(0).cast("long"))

    return let(_at_most(bounds, key), stretch)


def _tie(text: Column) -> Column:
    """A hash of the text that a double holds exactly, as quantiles are taken of doubles."""
    return F.shiftright(F.xxhash64(text), 11)


def _repeated(found: list[int] | None) -> list[int]:
    """Values that are two quantiles or more, so that each has a stretch's share of the rows."""
    found = found or []
    return sorted({a for a, b in zip(found, found[1:]) if a == b})


class Layout(NamedTuple):
    """How rows are dealt: bounds of ids, bounds of the ties of hot ids, and (id, tie) of hot copies."""

    bounds: list[int]
    cuts: int
    ties: dict[int | None, list[int]]
    copies: list[tuple[int | None, int]]

    def bucket(self) -> Column:
        """A number that ascends with (_id, _tie); a hot id, also null, has several."""
        # a hot id is a bound, or null: of its stretch only higher ids share it
        place = F.lit(FINE - 1)
        for value, ties in self.ties.items():
            inner = _at_most(ties, F.col("_tie"))
            place = F.when(F.col("_id").eqNullSafe(F.lit(value).cast("long")), inner).otherwise(place)
        return _bucket(self.bounds, self.cuts) * FINE + place

    def is_copy(self) -> Column:
        hit = F.lit(False)
        for value, tie in self.copies:
            hit = hit | (F.col("_id").eqNullSafe(F.lit(value).cast("long")) & (F.col("_tie") == tie))
        return hit


def layout(docs: DataFrame) -> Layout:
    """Stretches of like size over (_id, _tie), from quantiles.

    Ids with more rows than a stretch should hold are cut at quantiles of their ties. The driver
    gets `BOUNDS` quantiles at most, and as many for each hot id, of which there are fewer.
    """
    width = shuffle_width(docs.sparkSession)
    points = min(width, BOUNDS)
    at = [i / points for i in range(1, points)] or [0.5]
    quantiles = lambda c: F.percentile_approx(c, at, 20 * points).alias("b")
    null_id = F.col("_id").isNull()
    seen = docs.agg(quantiles("_id"), F.count(F.lit(1)).alias("n"), F.count_if(null_id).alias("nulls")).first()
    near = _repeated(seen["b"])
    # quantiles are exact up to 2 ** 53 only, so the ids themselves are looked up beside them
    held = F.coalesce(F.col("_id").cast("double").isin([float(v) for v in near]), F.lit(False)) if near else F.lit(False)
    held = held | null_id if seen["nulls"] * points > seen["n"] else held
    ties, copies = {}, []
    if near or seen["nulls"] * points > seen["n"]:
        large = F.col("n") * points >= F.lit(seen["n"])
        by_id = docs.where(held).groupBy("_id").agg(quantiles("_tie"), F.count(F.lit(1)).alias("n"))
        for row in by_id.where(large).collect():
            # as many stretches as its share of the rows asks for
            step = max(1, seen["n"] // row["n"])
            kept = row["b"][step - 1 :: step]
            ties[row["_id"]] = sorted(set(kept))
            copies += [(row["_id"], tie) for tie in _repeated(kept)]
    bounds = {*(seen["b"] or []), *(v for v in ties if v is not None)}
    return Layout(sorted(bounds), -(-width // points), ties, copies)


def collapsed(docs: DataFrame, dealt: Layout) -> DataFrame:
    """One row for the hot copies of a row, with `_more`, the number of the others; all other rows as they are."""
    plain = docs.withColumn("_more", F.lit(0).cast("long"))
    if not dealt.copies:
        return plain
    # combined by the tasks that read them, so one row per task and text is shuffled
    one = docs.where(dealt.is_copy()).groupBy(*docs.columns).agg((F.count(F.lit(1)) - 1).alias("_more"))
    return plain.where(~dealt.is_copy()).unionByName(one)


def with_next(docs: DataFrame, columns: list[str], dealt: Layout, **made: Column) -> DataFrame:
    """Add next_<column> from the next document by descending _id; the last one gets the first.

    Rows with equal ids follow each other by `_tie`; null ids come last. The rows are dealt to stretches
    of like size, and each stretch also gets a copy of the first row of the next one,
    so one shuffle of the texts is enough. The driver sees one id per stretch.

    `made`: columns worked out after the shuffle, so for each row and copy once, and not shuffled.
    """
    rows = docs.withColumn("_bucket", dealt.bucket())
    newest = F.max(F.struct("_id", "_tie")).alias("head")
    heads = rows.groupBy("_bucket").agg(newest).orderBy("_bucket").collect()
    guests = [(r["head"]["_id"], r["head"]["_tie"], (i + 1) % len(heads)) for i, r in enumerate(heads)]
    firsts = docs.sparkSession.createDataFrame(guests, "_gid bigint, _gtie bigint, _gbucket int")
    # stretches get numbers without gaps, which are those of their partitions: no two share one by chance
    number = F.greatest(_at_most([r["_bucket"] for r in heads], F.col("_bucket")) - 1, F.lit(0))
    rows = rows.withColumn("_bucket", number)
    # one row per stretch
    copies = docs.join(
        F.broadcast(firsts), docs["_id"].eqNullSafe(firsts["_gid"]) & (docs["_tie"] == firsts["_gtie"])
    ).select(*docs.columns, F.col("_gbucket").alias("_bucket"), F.lit(True).alias("_guest"))
    both = rows.withColumn("_guest", F.lit(False)).unionByName(copies)
    both = both.repartitionById(max(1, len(heads)), F.col("_bucket")).withColumns(made)
    order = Window.partitionBy("_bucket").orderBy("_guest", F.col("_id").desc_nulls_last(), F.col("_tie").desc())
    led = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    return both.select("*", *led).where(~F.col("_guest")).drop("_guest", "_bucket")


def multiplied(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as the column says, a row with a high number made by several tasks."""
    left = F.col(times) - F.col("_part") * COPIES_PER_TASK
    parts = F.sequence(F.lit(0), F.ceil(F.col(times) / COPIES_PER_TASK).cast("int") - 1)
    dealt = rows.where(F.col(times) > 0).withColumn("_part", F.explode(parts))
    dealt = dealt.repartition(shuffle_width(rows.sparkSession), "_part")
    again = F.explode(F.array_repeat(F.lit(1), F.least(left, F.lit(COPIES_PER_TASK)).cast("int")))
    return dealt.withColumn("_again", again).drop("_part", "_again")


def edited(text: Column, following: Column) -> Column:
    """The text with its last third replaced by as much from the start of another."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(following, F.lit(1), cut))


def edit_prints(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents and of their edited texts, with the likenesses.

    A null text counts as empty; two empty texts are alike to 1. One document is its own
    next. Repeated rows count one by one, equal ids follow each other by the hash of their
    texts, null ids come last. An id with a large share of the rows, also null, is dealt to several
    tasks; so many copies of one row are worked on as one and put out one by one.
    Other columns are left out; an empty table gives an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    given = docs.select(
        F.col("doc_id").cast("long").alias("_id"), text.alias("text"), _tie(text).alias("_tie")
    )
    dealt = layout(given)
    kept, own = collapsed(given, dealt), fingerprint(F.col("text"))
    out = _compared(with_next(kept, ["text", "fingerprint"], dealt, fingerprint=own))
    if dealt.copies:
        # all copies but the last are followed by another one
        printed = kept.where("_more > 0").withColumn("fingerprint", own)
        same = [F.col(c).alias(f"next_{c}") for c in ("text", "fingerprint")]
        followed = _compared(printed.select("*", *same))
        out = out.unionByName(multiplied(followed, "_more"))
    return out.drop("_more")


def _compared(paired: DataFrame) -> DataFrame:
    changed_text = paired.withColumn("_edited", edited(F.col("text"), F.col("next_text")))
    return changed_text.withColumn("edited_fingerprint", fingerprint(F.col("_edited"))).select(
        F.col("_id").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        "_more",
    )


def op10_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_prints(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op10_merkle_fingerprints": op10_merkle_fingerprints}

_TREE = """
  SELECT *, sha256(array_to_string(secs, '')) || '|'
         || array_to_string(list_transform(secs, lambda s: substr(s, 1, 12)), '.') || '|'
         || array_to_string(list_transform(leaves, lambda h: substr(h, 1, 12)), '.') AS {name}
  FROM (
    SELECT *, list_transform(ends, lambda e, i: sha256(array_to_string(
             leaves[CASE WHEN i > 1 THEN ends[i - 1] + 1 ELSE 1 END : e], ''))) AS secs
    FROM (
      SELECT *, list_filter(range(1, len(leaves) + 1), lambda i: i = len(leaves)
                 OR substr(leaves[i], 64, 1) IN ('0', '8')) AS ends
      FROM (
        SELECT *, list_transform(regexp_extract_all({text}, '{paragraph}'), lambda p: sha256(p)) AS leaves
        FROM {given}
      )
    )
  )
"""
_LIKE = """
  CASE WHEN {a} = {b} THEN 1.0
       WHEN len(list_distinct({la})) + len(list_distinct({lb})) = 0 THEN 1.0
       ELSE CAST(2.0 AS DOUBLE) * len(list_intersect(list_distinct({la}), list_distinct({lb})))
            / (len(list_distinct({la})) + len(list_distinct({lb}))) END
"""
_PARTS = "list_filter(string_split(split_part({f}, '|', 3), '.'), lambda x: x <> '')"


def _like(a: str, b: str) -> str:
    return _LIKE.format(a=a, b=b, la=_PARTS.format(f=a), lb=_PARTS.format(f=b))


ORACLE = {
    "op10_merkle_fingerprints": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
own AS ({_TREE.format(name="fingerprint", text="text", given="d", paragraph=PARAGRAPH)}),
paired AS (
  SELECT doc_id, text, fingerprint,
         coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text,
         coalesce(lead(fingerprint) OVER w, first_value(fingerprint) OVER w) AS next_fingerprint
  FROM own WINDOW w AS (ORDER BY doc_id DESC)
),
changed AS (
  SELECT *, substr(text, 1, length(text) - length(text) // 3)
            || substr(next_text, 1, length(text) // 3) AS edited
  FROM paired
),
both_prints AS ({_TREE.format(name="edited_fingerprint", text="edited", given="changed", paragraph=PARAGRAPH)})
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
       CAST({_like("fingerprint", "edited_fingerprint")} AS DOUBLE) AS near_edited,
       CAST({_like("fingerprint", "next_fingerprint")} AS DOUBLE) AS near_next
FROM both_prints
"""
}
