"""The function names the lake's SQL users know, as column helpers and in SQL text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

arbitrary = F.any_value
approx_distinct = F.approx_count_distinct
cardinality = F.size
sequence = F.sequence
from_unixtime = F.timestamp_seconds

_UNITS = ("year", "month", "week", "day", "hour", "minute", "second")


def _unit(unit: str) -> str:
    name = unit.lower().rstrip("s")
    if name not in _UNITS:
        raise ValueError(f"unknown date unit {unit!r}")
    return name


def date_add(unit: str, amount: int | Column, col: Column) -> Column:
    """`col` moved by `amount` units, a number or a column; calendar units keep the day where it exists."""
    number = F.lit(amount) if isinstance(amount, int) else amount
    return F.timestamp_add(_unit(unit), number.cast("int"), col)


def date_diff(unit: str, start: Column, end: Column) -> Column:
    """Whole units from `start` to `end`."""
    return F.timestamp_diff(_unit(unit), start, end)


# Names in SQL text that Spark has under another name (fixed values).
SQL_NAMES = {
    "arbitrary": "any_value", "approx_distinct": "approx_count_distinct", "from_unixtime": "timestamp_seconds",
}
_LITERAL = re.compile(r"('(?:[^']|'')*'|\"[^\"]*\")")
_UNIT_TEXT = re.compile(r"\b(date_diff|date_add)(\s*\(\s*)'(\w+)'(?=\s*,)", re.IGNORECASE)


def lake_text(text: str) -> str:
    """SQL text of the lake's users with the names above, units written as words, and `array[...]`, in Spark's way.

    Spark has `date_diff`, `date_add`, `cardinality`, `sequence` and intervals itself. Literals stay as
    they are.
    """
    text = _UNIT_TEXT.sub(lambda m: f"{m[1]}{m[2]}{_unit(m[3]).upper()}", text)
    pieces = _LITERAL.split(text)
    for i in range(0, len(pieces), 2):  # the odd ones are literals
        for name, own in SQL_NAMES.items():
            pieces[i] = re.sub(rf"\b{name}(?=\s*\()", own, pieces[i], flags=re.IGNORECASE)
        pieces[i] = re.sub(r"\barray\s*\[([^\[\]]*)\]", r"array(\1)", pieces[i], flags=re.IGNORECASE)
    return "".join(pieces)


def lake_sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text of the lake's users; `{name}` in it stands for a frame given by that name."""
    return spark.sql(lake_text(text), **tables)
