"""Quality reports for many CSV files at once, each with its own header.

The lines are scanned twice and never copied. A first pass counts the cells of every file and
position, which yields the headers, the column profiles and the sizes of the scan ranges;
a second pass applies the rules. Nothing is read per file on the driver, and a file's
lines are never gathered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.operators.quality import (
    DEFAULT_RULES,
    Rule,
    add_issues,
    column_type,
    flagged,
    profile_counted,
)
from almanac.session import checkpointed
from almanac.sinks.objects import write_objects
from almanac.sources.csv import CELLS, blank_na

# Position of the pseudo cell that carries the scan range of a line.
_RANGE = -1


@dataclass(frozen=True)
class FileQuality:
    """Frames of one run: `files` (one row per file), `columns` (one per file and column)
    and `issues` (one per line with issues)."""

    files: DataFrame
    columns: DataFrame
    issues: DataFrame


def _count_cells(lines: DataFrame) -> DataFrame:
    """Cells counted by file, position and text, with the first line each is seen in."""
    marked = F.concat(F.array(F.col("block").cast("string")), F.col(CELLS))
    exploded = lines.select("file", "block", "seq", F.posexplode(marked).alias("pos", "cell"))
    return (
        exploded.where(F.col("cell").isNotNull())
        .groupBy("file", (F.col("pos") + _RANGE).alias("pos"), "cell")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("seq").alias("first"),
            F.min(F.when(F.col("block") == 0, F.col("seq"))).alias("first_at_top"),
        )
    )


def _ranges(counted: DataFrame) -> DataFrame:
    """Scan ranges with the number of lines before them in the file."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.where(F.col("pos") == _RANGE).select(
        "file",
        F.col("cell").cast("bigint").alias("block"),
        F.col("n").alias("lines"),
        "first",
    ).withColumn("before", F.coalesce(F.sum("lines").over(before), F.lit(0)))


def _headers(counted: DataFrame) -> DataFrame:
    """The header cell of each file and position; a blank one gets a name by position.

    A header cell is found by its file and line, so no task gets all cells of a file or position.
    """
    top = counted.where((F.col("pos") == _RANGE) & (F.col("cell") == "0")).select(
        "file", F.col("first").alias("first_at_top")
    )
    cells = counted.where(F.col("pos") >= 0)
    # at most one cell per file and position
    heads = cells.join(top, ["file", "first_at_top"]).select("file", "pos", F.col("cell").alias("head"))
    return cells.select("file", "pos").distinct().join(heads, ["file", "pos"], "left").withColumn(
        "name", F.coalesce(F.col("head"), F.concat(F.lit("Unnamed: "), F.col("pos").cast("string")))
    )


def _columns(counted: DataFrame, headers: DataFrame, files: DataFrame) -> DataFrame:
    """Profile per file and column, the header line itself left out."""
    cells = counted.where(F.col("pos") >= 0).join(headers, ["file", "pos"])
    data = cells.withColumn(
        "n", F.col("n") - F.when(F.col("cell") == F.col("head"), 1).otherwise(0)
    ).where("n > 0")
    profile = profile_counted(
        data.select("file", "pos", blank_na(F.col("cell")).alias("cell"), "n"), ["file", "pos"]
    )
    full = headers.join(profile, ["file", "pos"], "left").join(
        files.select("file", "num_rows"), "file"
    )
    counts = ["non_null_count", "unique", "_numbers", "_wholes", "_booleans"]
    filled = full.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in counts})
    all_flags = F.col("non_null_count") == F.col("_booleans")
    return filled.select(
        "file", "pos", "name", "non_null_count", "unique",
        column_type(
            F.col("num_rows"), F.col("non_null_count"), F.col("_numbers"), F.col("_wholes"),
            F.col("_booleans"),
        ).alias("dtype"),
        ((F.col("_numbers") == F.col("non_null_count")) | all_flags).alias("numeric"),
    )


def _layout(columns: DataFrame) -> DataFrame:
    """Per file the column names and whether each is numeric, in file order (few per file)."""
    listed = F.array_sort(F.collect_list(F.struct("pos", "name", "numeric")))
    return columns.groupBy("file").agg(listed.alias("c")).select(
        "file", F.col("c.name").alias("names"), F.col("c.numeric").alias("numerics"),
        F.col("c.pos").alias("places"),
    )


def _cell(column: str) -> tuple[Column, Column]:
    """The cell of a named column and whether its column is numeric; NULL if absent."""
    at = F.array_position(F.col("names"), F.lit(column)).cast("int")
    place = F.when(at > 0, F.get("places", at - 1))
    value = F.get(F.col(CELLS), place)
    return blank_na(value), F.coalesce(F.get("numerics", at - 1), F.lit(False))


def check_files(lines: DataFrame, rules: list[Rule] | None = None) -> FileQuality:
    """Check the lines read by `read_csv_cells` against the rules."""
    rules = rules or DEFAULT_RULES
    counted = checkpointed(_count_cells(lines))
    ranges = _ranges(counted)
    sizes = ranges.groupBy("file").agg((F.sum("lines") - 1).alias("num_rows"))
    # stored, so their size is known and the planner can send small ones to the lines
    headers = checkpointed(_headers(counted))
    columns = checkpointed(_columns(counted, headers, sizes))
    layout = checkpointed(_layout(columns))

    placed = add_issues(lines.join(layout, "file"), rules, [_cell(r.column) for r in rules])
    found = flagged(placed.select("file", "block", "seq", "issues"))
    issues = checkpointed(
        found.join(ranges, ["file", "block"])
        .withColumn("row_index", F.col("before") + F.col("seq") - F.col("first") - 1)
        .where("row_index >= 0")
        .select("file", "row_index", "issues")
    )

    totals = issues.groupBy("file").agg(F.sum(F.size("issues")).cast("bigint").alias("total_issues"))
    required = F.array(*[F.lit(r.column) for r in rules if r.required])
    files = sizes.join(layout, "file").join(totals, "file", "left").select(
        "file",
        "num_rows",
        F.size("names").alias("num_columns"),
        F.col("names").alias("columns_present"),
        F.array_except(required, "names").alias("missing_required_columns")
        if any(r.required for r in rules)
        else F.array().cast("array<string>").alias("missing_required_columns"),
        F.coalesce("total_issues", F.lit(0).cast("bigint")).alias("total_issues"),
    )
    profile = columns.select("file", "pos", "name", "non_null_count", "unique", "dtype")
    return FileQuality(files, profile, issues)


# ---- report documents ------------------------------------------------------------------


def _issue_json(i: Column) -> Column:
    head = [i["column"].alias("column"), i["issue"].alias("issue")]
    keep = {"ignoreNullFields": "false"}
    number = F.to_json(F.struct(*head, i["value"].cast("decimal(38,0)").alias("value")), keep)
    typed = F.to_json(
        F.struct(*head, i["expected"].alias("expected"), i["value"].alias("value")), keep
    )
    plain = F.to_json(F.struct(*head, i["value"].alias("value")), keep)
    return F.when(i["issue"] == "out_of_range", number).when(
        i["expected"].isNotNull(), typed
    ).otherwise(plain)


def report_lines(checked: FileQuality) -> DataFrame:
    """The JSON report of each file as lines: a head, one line per row with issues, a tail.

    Ordered by (file, part, row_index) the lines of a file are its document, whatever its
    number of issues; no file's issues are gathered in one row.
    """
    stats = F.concat(
        F.regexp_replace(F.to_json(F.array("name")), r"^\[|\]$", ""),
        F.lit(": "),
        F.to_json(F.struct("non_null_count", "unique", "dtype")),
    )
    # a few entries per file, one for each column of its header
    columns = checked.columns.groupBy("file").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("pos", stats.alias("text")))), lambda c: c["text"]
            ),
            ", ",
        ).alias("column_text")
    )
    first = checked.issues.groupBy("file").agg(F.min("row_index").alias("first_row"))
    rows = checked.issues.join(first, "file").select(
        "file",
        F.lit(1).alias("part"),
        "row_index",
        F.concat(
            F.when(F.col("row_index") > F.col("first_row"), ", ").otherwise(""),
            F.lit('"'), F.col("row_index").cast("string"), F.lit('": ['),
            F.array_join(F.transform("issues", _issue_json), ", "), F.lit("]"),
        ).alias("line"),
    )
    head = F.concat(
        F.lit('{"num_rows": '), F.col("num_rows").cast("string"),
        F.lit(', "num_columns": '), F.col("num_columns").cast("string"),
        F.lit(', "columns_present": '), F.to_json("columns_present"), F.lit(', "row_issues": {'),
    )
    tail = F.concat(
        F.lit('}, "summary": {"columns": {'), F.col("column_text"),
        F.lit('}}, "missing_required_columns": '), F.to_json("missing_required_columns"),
        F.lit(', "total_issues": '), F.col("total_issues").cast("string"), F.lit("}"),
    )
    ends = checked.files.join(columns, "file").select(
        "file",
        F.posexplode(F.array(F.struct(F.lit(0).alias("part"), head.alias("line")),
                             F.struct(F.lit(2).alias("part"), tail.alias("line")))).alias("_n", "e"),
    ).select("file", F.col("e.part").alias("part"), F.lit(-1).cast("bigint").alias("row_index"), F.col("e.line").alias("line"))
    return ends.unionByName(rows)


def report_key(file: Column, source: str) -> Column:
    """`reports/<path below the source>.qc.json`, with the path decoded."""
    root = source.split("://", 1)[-1].removeprefix("file:").strip("/") + "/"
    path = F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))
    below = F.substring(path, F.instr(path, root) + len(root), F.length(path))
    return F.concat(F.lit("reports/"), below, F.lit(".qc.json"))


def write_reports(checked: FileQuality, source: str, path: str) -> str:
    """Write every report as one JSON document, the object `path`/reports/<key>.qc.json."""
    keyed = report_lines(checked).withColumn("report_key", report_key(F.col("file"), source))
    return write_objects(keyed, "report_key", ["part", "row_index"], "line", path)


def issue_documents(checked: FileQuality) -> DataFrame:
    """One JSON line per row with issues, for files of any size."""
    return checked.issues.select(
        "file", "row_index",
        F.concat(
            F.lit("["), F.array_join(F.transform("issues", _issue_json), ", "), F.lit("]")
        ).alias("issues"),
    )


def verdicts(files: DataFrame) -> DataFrame:
    """Number of files that pass and fail: a pass has no issue and no missing column."""
    passed = (F.col("total_issues") == 0) & (F.size("missing_required_columns") == 0)
    status = F.when(passed, "pass").otherwise("fail")
    return files.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("files"))


def quality_trend(files: DataFrame, checked_at: str = "checked_at") -> DataFrame:
    """Files, rows and issues per day over stored reports."""
    return files.groupBy(F.to_date(checked_at).alias("day")).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("num_rows").alias("rows"),
        F.sum("total_issues").alias("issues"),
    )
