"""Row rules compiled to columns, and table-level checks.

A rule set is an ordered list of `Rule`. Each rule becomes column expressions, so all
rules run in one pass over the rows, inside generated code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.dates import parse_date_text
from almanac.functions.numbers import WHOLE, is_true, to_number

ISSUE_TYPE = "struct<column:string,issue:string,expected:string,value:string>"
# Whole numbers inside a text column may group digits with underscores (fixed pattern).
WHOLE_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"
RULE_TYPES = ("int", "str", "date")


@dataclass(frozen=True)
class Rule:
    """What a column must hold. `unique` is off by default and only for whole tables."""

    column: str
    type: str = "str"
    required: bool = False
    min: int | None = None
    max: int | None = None
    unique: bool = False

    def __post_init__(self) -> None:
        if self.type not in RULE_TYPES:
            raise ValueError(f"rule type must be one of {RULE_TYPES}, not {self.type!r}")


DEFAULT_RULES = [
    Rule("id", "int", required=True),
    Rule("name", "str", required=True),
    Rule("age", "int", required=True, min=0, max=120),
    Rule("email", "str"),
    Rule("signup_date", "date"),
]


def rules_from_schema(schema: dict[str, dict]) -> list[Rule]:
    """Rules from a plain dictionary: column -> {required, type, min, max, unique}."""
    return [Rule(column, **{"type": "str", **spec}) for column, spec in schema.items()]


def issue(column: str, kind: str, value: Column | None = None, expected: str | None = None) -> Column:
    return F.struct(
        F.lit(column).alias("column"),
        F.lit(kind).alias("issue"),
        F.lit(expected).cast("string").alias("expected"),
        (F.lit(None) if value is None else value).cast("string").alias("value"),
    )


def cut_number(value: Column) -> Column:
    """The whole part of a number or boolean in text, NULL if it has none."""
    number = F.when(F.lower(value) == "true", 1.0).when(F.lower(value) == "false", 0.0).otherwise(
        to_number(value)
    )
    # an infinite number has no whole part
    return F.try_divide(number, F.when(F.abs(number) != float("inf"), 1.0))


def whole_part(value: Column, number: Column, numeric: Column) -> Column:
    """The integer a value stands for, NULL if none.

    In a numeric column a fraction is cut off; in a text column only whole-number text
    counts. Booleans count as 0 and 1.
    """
    digits = F.replace(F.trim(value), F.lit("_"), F.lit(""))
    exact = F.when(value.rlike(WHOLE_TEXT), digits.try_cast("decimal(38,0)"))
    cut = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("decimal(38,0)")
    return F.coalesce(exact, F.when(numeric, cut))


def add_issues(
    df: DataFrame, rules: list[Rule], cells: list[tuple[Column, Column]], more: list[Column] | None = None
) -> DataFrame:
    """Add `issues`, the array of all issues of a row in rule order.

    `cells` gives for each rule the cell as text and whether its column holds numbers only.
    Each is evaluated once, in steps: cells, numbers, whole parts, issues.
    """
    names = df.columns
    step = {}
    for i, (value, numeric) in enumerate(cells):
        step |= {f"_v{i}": value, f"_n{i}": numeric}
    df = df.withColumns(step)
    whole = [i for i, rule in enumerate(rules) if rule.type == "int"]
    dates = [i for i, rule in enumerate(rules) if rule.type == "date"]
    df = df.withColumns({f"_c{i}": cut_number(F.col(f"_v{i}")) for i in whole}) if whole else df
    step = {f"_w{i}": whole_part(F.col(f"_v{i}"), F.col(f"_c{i}"), F.col(f"_n{i}")) for i in whole}
    step |= {f"_d{i}": parse_date_text(F.col(f"_v{i}")).isNull() for i in dates}
    df = df.withColumns(step) if step else df
    found: list[Column] = []
    for i, rule in enumerate(rules):
        value = F.col(f"_v{i}")
        if rule.required:
            found.append(F.when(value.isNull(), issue(rule.column, "missing")))
        if rule.type == "int":
            part = F.col(f"_w{i}")
            mismatch = issue(rule.column, "type_mismatch", value, expected="int")
            found.append(F.when(value.isNotNull() & part.isNull(), mismatch))
            outside = issue(rule.column, "out_of_range", part)
            if rule.min is not None:
                found.append(F.when(part < rule.min, outside))
            if rule.max is not None:
                found.append(F.when(part > rule.max, outside))
        elif rule.type == "date":
            unread = value.isNotNull() & F.col(f"_d{i}")
            found.append(F.when(unread, issue(rule.column, "invalid_date", value)))
    issues = F.array(*found, *(more or [])) if found or more else F.array().cast(f"array<{ISSUE_TYPE}>")
    return df.select(*names, F.array_compact(issues).alias("issues"))


def flagged(df: DataFrame) -> DataFrame:
    """Only rows with issues.

    The line counter keeps the filter above the projection; without it the optimizer would
    evaluate every rule twice, once for the filter and once for the result.
    """
    counted = df.withColumn("_line", F.monotonically_increasing_id())
    return counted.where((F.col("_line") >= 0) & (F.size("issues") > 0)).drop("_line")


def numeric_columns(df: DataFrame, columns: list[str]) -> set[str]:
    """Columns that hold numbers only: by type, or by one pass over those that are text."""
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    present = [c for c in columns if c in types]
    texts = [c for c in present if types[c] == "string"]
    others = {c for c in present if types[c] not in ("string", "date", "timestamp", "timestamp_ntz")}
    if not texts:
        return others
    all_numbers = df.agg(
        *[F.bool_and(F.col(c).isNull() | to_number(F.col(c)).isNotNull()).alias(c) for c in texts]
    ).first()
    return others | {c for c in texts if all_numbers[c]}


def with_issues(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Add `issues`, the array of all issues of the row in rule order."""
    rules = rules or DEFAULT_RULES
    names = df.columns
    numeric = numeric_columns(df, [r.column for r in rules if r.type == "int"])
    cells = [(_text(df, r.column), F.lit(r.column in numeric)) for r in rules]
    more = []
    for rule in rules:
        if rule.unique and rule.column in names:
            df = _mark_duplicates(df, rule.column)
            repeated = issue(rule.column, "duplicate", F.col(rule.column))
            more.append(F.when(F.col(f"_dup_{rule.column}"), repeated))
    return add_issues(df, rules, cells, more).select(*names, "issues")


def _text(df: DataFrame, column: str) -> Column:
    """The column as text, NULL if the frame does not have it."""
    return (F.col(column) if column in df.columns else F.lit(None)).cast("string")


def _mark_duplicates(df: DataFrame, column: str) -> DataFrame:
    repeated = (
        df.where(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        .select(column, F.lit(True).alias(f"_dup_{column}"))
    )
    # rows without a key would all meet in one partition of the join
    keyed = df.where(F.col(column).isNotNull()).join(repeated, column, "left").withColumn(
        f"_dup_{column}", is_true(F.col(f"_dup_{column}"))
    )
    return keyed.unionByName(df.where(F.col(column).isNull()).withColumn(f"_dup_{column}", F.lit(False)))


def row_issues(df: DataFrame, key: str, rules: list[Rule] | None = None) -> DataFrame:
    """One row per issue: the key of the row, the issue's place in the row, and the issue."""
    checked = with_issues(df, rules)
    return checked.select(F.col(key).alias("row_id"), F.posexplode("issues").alias("place", "i")).select(
        "row_id", "place", "i.column", "i.issue", "i.expected", "i.value"
    )


def total_issues(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    checked = with_issues(df, rules)
    return checked.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count_if(F.size("issues") > 0).alias("rows_with_issues"),
        F.coalesce(F.sum(F.size("issues")), F.lit(0)).cast("bigint").alias("total_issues"),
    )


def issue_counts(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    exploded = with_issues(df, rules).select(F.explode("issues").alias("i"))
    return exploded.groupBy("i.column", "i.issue").agg(F.count(F.lit(1)).alias("n"))


def missing_required(columns: list[str], rules: list[Rule] | None = None) -> list[str]:
    return [r.column for r in rules or DEFAULT_RULES if r.required and r.column not in columns]


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Key values held by more than one row, with the number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def prototype_issues(
    df: DataFrame, required: list[str] | None = None, age: str = "age", low: int = 0, high: int = 120
) -> DataFrame:
    """The first rule set: `missing_required`, then `not_integer` or `age_out_of_range`.

    A missing age gives both a missing and a not-integer issue.
    """
    required = required or ["id", "name", "age"]
    names = df.columns
    missing = [F.when(_text(df, c).isNull(), issue(c, "missing_required")) for c in required]
    numeric = F.lit(age in numeric_columns(df, [age]))
    value = _text(df, age)
    df = df.withColumn("_cut", cut_number(value))
    df = df.withColumn("_whole", whole_part(value, F.col("_cut"), numeric))
    whole = F.col("_whole")
    found = missing + [
        F.when(whole.isNull(), issue(age, "not_integer", value)),
        F.when((whole < low) | (whole > high), issue(age, "age_out_of_range", whole)),
    ]
    return df.select(*names, F.array_compact(F.array(*found)).alias("issues"))


# ---- column profile --------------------------------------------------------------------


def column_type(
    rows: Column, non_null: Column, numbers: Column, wholes: Column, booleans: Column
) -> Column:
    """The type a column read from text gets, from counts of its cells."""
    full = non_null == rows
    return (
        F.when(rows == 0, "object")
        .when(non_null == 0, "float64")
        .when((booleans == non_null) & full, "bool")
        .when((wholes == non_null) & full, "int64")
        .when(numbers == non_null, "float64")
        .otherwise("object")
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Non-null count, distinct values and type per column of a table.

    Cells are stacked to (column, text) and counted first, so one pass and one shuffle of
    combined values serve all columns; the NULL cells are counted too and give the rows.
    """
    cells = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    long = cells.unpivot([], df.columns, "column", "cell")
    counted = long.groupBy("column", "cell").agg(F.count(F.lit(1)).alias("n"))
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column string")
    counts = ["_rows", "non_null_count", "unique", "_numbers", "_wholes", "_booleans"]
    # an empty table has no cells but still its columns
    full = names.join(profile_counted(counted, ["column"]), "column", "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in counts}
    )
    return full.select(
        "column",
        "non_null_count",
        "unique",
        column_type(
            F.col("_rows"), F.col("non_null_count"), F.col("_numbers"), F.col("_wholes"),
            F.col("_booleans"),
        ).alias("dtype"),
    )


def profile_counted(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Profile of counted cells (keys, cell, n): counts by kind and distinct values.

    Distinct numbers are compared as numbers if all cells are numbers, else as text.
    """
    cell, n = F.col("cell"), F.col("n")
    number = to_number(cell)
    by_number = counted.groupBy(*keys, number.alias("_number")).agg(
        F.sum(n).alias("_all"),
        F.sum(F.when(cell.isNotNull(), n)).alias("_cells"),
        F.count(cell).alias("_texts"),
        F.sum(F.when(cell.rlike(WHOLE), n)).alias("_wholes"),
        F.sum(F.when(F.lower(cell).isin("true", "false"), n)).alias("_booleans"),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    numbers = F.coalesce(F.sum(F.when(F.col("_number").isNotNull(), F.col("_cells"))), F.lit(0))
    grouped = by_number.groupBy(*keys).agg(
        total("_all").alias("_rows"),
        total("_cells").alias("non_null_count"),
        total("_texts").alias("_distinct_texts"),
        F.count("_number").alias("_distinct_numbers"),
        numbers.cast("bigint").alias("_numbers"),
        total("_wholes").alias("_wholes"),
        total("_booleans").alias("_booleans"),
    )
    all_numbers = F.col("_numbers") == F.col("non_null_count")
    return grouped.withColumn(
        "unique", F.when(all_numbers, F.col("_distinct_numbers")).otherwise(F.col("_distinct_texts"))
    )
