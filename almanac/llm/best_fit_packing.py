"""Best-fit packing of token sequences with matching of the large items.

Documents become token ids and longer ones are cut into full sequences, the first piece
taking the remainder. Pieces above one third of the capacity are matched greedily, at most
two per sequence, the largest partner that fits first; smaller pieces go, largest first, into
the tightest gap that holds them, and into new sequences when none does.

Piece lengths are whole numbers up to the capacity, so the packing is planned on the count
of pieces per length: sequences with the same content are one row of the plan, whatever
their number. The plan has a few rows per length and does not grow with the corpus. Each piece finds its place by
its rank among the pieces of its length. Ranks are a count per task plus an offset per
(task, length), so a length that a third of all pieces share is numbered by all tasks.
"""

from __future__ import annotations

import bisect
import functools
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm.common import stored, table, without

CAPACITY = 1024
END_ID = 2
# Words whose ids a task remembers; a full store starts anew, which changes no result.
REMEMBERED = 300_000
_PIECES = "piece int, start bigint, length int, ids_crc32 bigint, ids binary, _task int, _rank bigint"
OUTPUTS = ("piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")


def vocabulary_path() -> str:
    """The installed byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=1)
def _vocabulary(path: str) -> tuple[Callable[[str], list[int]], list[dict]]:
    """The encoding function of a vocabulary file and its added tokens.

    It is built once per worker process, not per task, as building takes several times the memory of what stays.
    """
    import json

    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    added = given.get("added_tokens") or []
    model = given.pop("model")
    # the printable characters that stand for the 256 bytes in such files
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    letter = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    last = -1
    for m in model.pop("merges"):
        merged = model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))]
        if last >= merged:
            raise ValueError("the ids of this vocabulary are not in merge order")
        last = merged
    ranks = {
        bytes(letter[c] for c in token): rank
        for token, rank in model.pop("vocab").items()
        if all(c in letter for c in token) and not token.startswith("<|")
    }
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoding.encode_ordinary, added


class Encoder:
    """Ids of a byte-level vocabulary file, as little-endian unsigned 32-bit bytes.

    The vocabulary comes from the `tokenizers` file; its ids are in merge order, which is
    checked, so `tiktoken` gives the same ids, some five times faster. Text between single
    blanks or line feeds is encoded word by word, as tokens never reach over such a place;
    texts with longer white space, or with zero characters, are encoded whole. With `added` the
    file's added tokens get their ids and the text is split there, as `tokenizers` does; without,
    the names of special ones are ordinary text.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED, added: bool = False):
        import regex

        self._encode, tokens = _vocabulary(path)
        split = [t for t in tokens if added or not t["special"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in split):
            raise ValueError("added tokens that depend on the text beside them are not known")
        self._added = {t["content"]: np.asarray([t["id"]], "<u4").tobytes() for t in split}
        longest_first = sorted(self._added, key=lambda name: (-len(name), name))
        self._at_added = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if split else None
        self._wide = regex.compile(r"\s\s|[^\S \n]|\x00").search
        self._known: dict[str, bytes] = {}
        self._remembered = remembered

    def _bytes(self, text: str) -> bytes:
        return np.asarray(self._encode(text), "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self._at_added is None or not self._at_added.search(text):
            return self._plain(text)
        # every second part is an added token
        parts = self._at_added.split(text)
        return b"".join(self._added[x] if i % 2 else self._plain(x) for i, x in enumerate(parts) if x)

    def _plain(self, text: str) -> bytes:
        if self._wide(text):
            return self._bytes(text)
        known, out = self._known, []
        if len(known) > self._remembered:
            known.clear()
        spaced = text.replace("\n", "\x00\n\x00").replace(" ", "\x00 ").split("\x00")
        for word in spaced:
            got = known.get(word)
            if got is None:
                got = known[word] = self._bytes(word)
            out.append(got)
        return b"".join(out)


def _tokenize(path: str, capacity: int, end_id: int, with_ids: bool, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path, added=added)
        end = np.asarray([end_id], "<u4").tobytes()
        task = TaskContext.get().partitionId()
        ranks: dict[int, int] = {}
        for batch in batches:
            at = batch.schema.get_field_index("_pack_text")
            texts = batch.column(at)
            keep = pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns) if i != at],
                [n for i, n in enumerate(batch.schema.names) if i != at],
            )
            for begin in range(0, batch.num_rows, 256):
                rows, piece, start, length, crc, ids, rank = [], [], [], [], [], [], []
                for row in range(begin, min(begin + 256, batch.num_rows)):
                    data = encode(texts[row].as_py() or "") + end
                    total = len(data) // 4
                    cut = total % capacity or capacity
                    first, number = 0, 0
                    while first < total:
                        part = data[4 * first : 4 * cut]
                        size = cut - first
                        rows.append(row)
                        piece.append(number)
                        start.append(first)
                        length.append(size)
                        crc.append(zlib.crc32(part))
                        ids.append(part if with_ids else None)
                        rank.append(ranks.get(size, 0))
                        ranks[size] = rank[-1] + 1
                        first, cut, number = cut, cut + capacity, number + 1
                own = keep.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *own.columns,
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int32()),
                        pa.array(crc, pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([task] * len(rows), pa.int32()),
                        pa.array(rank, pa.int64()),
                    ],
                    [*keep.schema.names, *(p.split(" ")[0] for p in _PIECES.split(", "))],
                )

    return run


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True,
    added: bool = False,
) -> DataFrame:
    """The pieces of each document, beside its columns other than text."""
    own = without(docs, "text", "_pack_text", "_task", "_rank", *OUTPUTS)
    given = docs.select(*own.columns, F.col("text").alias("_pack_text"))
    kept = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in own.schema.fields)
    schema = f"{kept}, {_PIECES}" if kept else _PIECES
    return given.mapInArrow(_tokenize(path, capacity, end_id, with_ids, added), schema)


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces go, from the number of pieces per length.

    Rows are (length, first rank, count, first sequence, offset): the `count` pieces of that
    length from that rank on lie at `offset` of as many sequences in a row.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free room -> runs of (first sequence, count)
    used = dict.fromkeys(counts, 0)
    left = {length: n for length, n in counts.items() if n}
    sequences = 0

    def place(length: int, n: int, first: int, offset: int) -> None:
        rows.append((length, used[length], n, first, offset))
        used[length] += n
        left[length] -= n

    def opened(room: int, first: int, n: int) -> None:
        if room and n:
            gaps.setdefault(room, []).append((first, n))

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for length in large:
        while left[length]:
            partner = next((x for x in large if x <= min(length, capacity - length) and left[x]), None)
            if partner == length:
                pairs = left[length] // 2
                if not pairs:
                    partner = next((x for x in large if x < length and x <= capacity - length and left[x]), None)
            if partner is None:
                n = left[length]
                place(length, n, sequences, 0)
                opened(capacity - length, sequences, n)
            else:
                n = left[length] // 2 if partner == length else min(left[length], left[partner])
                place(length, n, sequences, 0)
                place(partner, n, sequences, length)
                opened(capacity - length - partner, sequences, n)
            sequences += n
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            rooms = sorted(room for room, runs in gaps.items() if runs)
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                # whole new sequences of this length; the rest share one more
                each = capacity // length
                n = max(1, left[length] // each)
                depth = min(each, left[length])
                for k in range(depth):
                    place(length, n, sequences, k * length)
                room = capacity - depth * length
                opened(room, sequences, n)
                sequences += n
            else:
                room = rooms[at]
                first, many = gaps[room].pop()
                n = min(many, left[length])
                place(length, n, first, capacity - room)
                opened(room - length, first, n)
                opened(room, first + n, many - n)
    return rows


def _plan_frame(spark: SparkSession, rows: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """The plan as a local relation; a list of rows would start Python workers beside those of the tokenizer."""
    names = ("_length", "_first", "_count", "_sequence", "offset")
    columns = [list(c) for c in zip(*rows)] or [[] for _ in names]
    return spark.createDataFrame(
        pa.table([pa.array(c, pa.int32() if n == "_length" else pa.int64()) for n, c in zip(names, columns)], list(names))
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to stored pieces.

    The counts per length that come to the driver are at most `capacity` numbers.
    """
    spark = pieces.sparkSession
    runs = pieces.groupBy("_task", "length").agg(F.count(F.lit(1)).alias("n"))
    # one row per task of the tokenizing stage
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = {r["length"]: r["n"] for r in runs.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = _plan_frame(spark, packing_plan(counts, capacity))
    by_length = plan.groupBy("_length").agg(
        F.sort_array(F.collect_list(F.struct("_first", "_count", "_sequence", "offset"))).alias("_places")
    )
    rank = F.col("_rank")
    place = F.filter("_places", lambda p: (p["_first"] <= rank) & (rank < p["_first"] + p["_count"]))[0]
    ranked = pieces.join(starts.drop("n"), ["_task", "length"]).withColumn(
        "_rank", F.col("_rank") + F.col("_before")
    )
    # the plan has at most a few rows for each of `capacity` lengths
    placed = ranked.join(F.broadcast(by_length), F.col("length") == F.col("_length"))
    return (
        placed.withColumn("_place", place)
        .withColumn("sequence_id", F.col("_place._sequence") + F.col("_rank") - F.col("_place._first"))
        .withColumn("offset", F.col("_place.offset"))
        .drop("_places", "_place", "_length", "_before", "_rank", "_task")
    )


def pack_documents(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True,
    added: bool = False,
) -> DataFrame:
    """One row per piece: the document's columns but text, then the outputs.

    A null or empty text is the end id alone. Repeated rows and null ids are packed each by
    itself; an empty table gives an empty table. A very long text is a piece per `capacity`
    ids. Columns with the names of the outputs are replaced. With `added`, names of the file's
    added tokens in a text are those tokens.
    """
    pieces = token_pieces(docs, path or vocabulary_path(), capacity, end_id, with_ids, added)
    return pack(stored(pieces, "pieces"), capacity)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack_documents(docs, with_ids=False, added=True)
    return packed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )


QUERIES = {"op8_best_fit_packing": op8_best_fit_packing}
ORACLE: dict[str, str] = {}
