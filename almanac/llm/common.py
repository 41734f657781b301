"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.session import staging_path

# The white space that separates words: blank, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once per row, also where `body` loops over it."""
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, name: str, compression: str = "snappy", files: int | None = None) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back: a cut in the lineage that a
    lost executor does not undo, with a size the planner knows.

    `files`: at most so many, for frames that a shuffle deals out over more tasks than their size is
    worth. On a local file system every file lets the executor start `chmod` four times.
    """
    path = staging_path(df.sparkSession, name)
    (df if files is None else df.coalesce(files)).write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by name whatever their case, so that an operator's own columns are unique."""
    taken = {name.lower() for name in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def words(text: Column) -> Column:
    """Array of the words between white space; empty for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def crc32_mod(ids: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n: the split into learning and held-out rows."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % n


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection, so no two values meet)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# DuckDB: the unsigned crc32 of a text's UTF-8 bytes, bit by bit.
CRC32_SQL = (
    "xor(list_reduce(list_transform(range(octet_length(encode({text}))), "
    "lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT), "
    "lambda c, b: list_reduce(range(8), lambda d, k: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) "
    "ELSE d >> 1 END, xor(c, b)), 4294967295), 4294967295)"
)
