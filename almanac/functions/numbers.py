"""Numeric coercion and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Spellings of numbers in text files (fixed values).
WHOLE = r"^\s*[+-]?\d+\s*$"
DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def to_number(col: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL instead of raising."""
    text = F.trim(col.cast("string"))
    endless = F.when(text.startswith("-"), float("-inf")).otherwise(float("inf"))
    return F.when(text.rlike(DECIMAL), text.try_cast("double")).when(text.rlike(INFINITE), endless)


def percent_change(current: Column, base: Column) -> Column:
    """100 * (current - base) / base, NULL for a base of 0."""
    return F.lit(100.0) * (current - base) / F.nullif(base, F.lit(0.0))


def share_of(part: Column, whole: Column) -> Column:
    """part / whole; an absent or zero whole counts as 1."""
    return part / F.coalesce(F.nullif(whole, F.lit(0.0)), F.lit(1.0))


def is_true(flag: Column) -> Column:
    """A comparison with NULL counts as false."""
    return F.coalesce(flag, F.lit(False))
