"""CSV sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.session import shuffle_width

# Cell texts that count as missing (fixed values).
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
CELLS = "cells"


def blank_na(col):
    """The missing-value texts become NULL."""
    return F.when(~col.isin(NA_TEXTS), col)


def read_csv(
    spark: SparkSession, path: str, encoding: str = "UTF-8", multiline: bool = False
) -> DataFrame:
    """A CSV table with header: all columns text, missing-value texts NULL, names as they are."""
    raw = spark.read.options(header="true", **csv_options(encoding, multiline)).csv(path)
    return raw.select(*[blank_na(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def read_csv_defensive(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A Latin-1 export as text, with `_line_no` giving the input order. A missing file raises.

    Several files follow each other by name: a line's place is its file, the scan range in
    the file, and its number there. Dates and numbers are parsed later, so no value can make the scan fail.
    """
    raw = spark.read.options(header="true", **csv_options("ISO-8859-1", multiline)).csv(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return raw.select(*[blank_na(F.col(f"`{c}`")).alias(c) for c in raw.columns], place.alias("_line_no"))


def cell_schema(width: int) -> str:
    return ", ".join(f"_c{i} string" for i in range(width + 1))


def with_place(rows: DataFrame) -> DataFrame:
    """Add the file of each line and the start of its scan range in that file."""
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def cells_of(rows: DataFrame, width: int) -> DataFrame:
    """Lines of many files, each with its own header, as arrays of cells.

    Adds a number that grows with the line inside its scan range. A line (with `multiline`: a record)
    with more than `width` cells is an error: raise the width rather than lose cells.
    """
    too_wide = F.raise_error(F.lit(f"a line has more than {width} cells; raise the width"))
    cells = F.array(*[F.col(f"_c{i}") for i in range(width)])
    used = F.array_max(
        F.transform(cells, lambda c, i: F.when(c.isNotNull(), i + 1).otherwise(F.lit(0)))
    )
    return rows.select(
        "file",
        "block",
        F.monotonically_increasing_id().alias("seq"),
        F.when(F.col(f"_c{width}").isNotNull(), too_wide)
        .otherwise(F.slice(cells, F.lit(1), used))
        .alias(CELLS),
    )


def csv_options(encoding: str = "UTF-8", multiline: bool = False) -> dict[str, str]:
    return {
        "encoding": encoding, "multiLine": str(multiline).lower(), "quote": '"', "escape": '"',
        "mode": "PERMISSIVE",
    }


def widest_line(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> int:
    """An upper bound of the cells per line: one more than the most commas in a line."""
    lines = spark.read.option("encoding", encoding).text(path)
    commas = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))
    return (lines.agg(F.max(commas)).first()[0] or 0) + 1


def widest_record(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> int:
    """The most cells of a record, where quoted cells may hold commas and line breaks.

    The parser finds the records: read with one column, every wider record is kept as it stands, and
    the commas outside its quotes are counted.
    """
    options = csv_options(encoding, multiline=True) | {"columnNameOfCorruptRecord": "_record"}
    records = spark.read.options(**options).schema("_c0 string, _record string").csv(path)
    bare = F.regexp_replace("_record", '"[^"]*"', "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    # both columns are read, as the parser does not keep records for the kept one alone
    found = records.select(F.when(F.col("_record").isNotNull(), commas).otherwise(F.lit(0)).alias("n"), "_c0")
    return (found.agg(F.max("n").alias("n"), F.count("_c0")).first()["n"] or 0) + 1


def read_csv_cells(
    spark: SparkSession,
    path: str | list[str],
    width: int | None = None,
    encoding: str = "UTF-8",
    multiline: bool = False,
) -> DataFrame:
    """The lines of all files under the paths as cells, the header lines among them.

    The parser is slow for columns nobody uses, so the width is measured unless given. With `multiline` one
    task parses a file of any size, so its records are dealt out before anything is done with them.
    """
    width = width or (widest_record if multiline else widest_line)(spark, path, encoding)
    reader = spark.read.options(**csv_options(encoding, multiline)).schema(cell_schema(width))
    cells = cells_of(with_place(reader.csv(path)), width)
    return cells.repartition(shuffle_width(spark), "file", "seq") if multiline else cells
