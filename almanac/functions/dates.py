"""Date parsing, truncation and reference-date arithmetic.

Reference dates are always arguments; nothing here reads the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date texts accepted by the date rule: the shape of the text and the format that reads it
# (fixed values). The first format that matches and reads wins.
DATE_SHAPES = [
    (r"\d{4}-\d{2}-\d{2}", "yyyy-MM-dd"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}", "yyyy-MM-dd HH:mm"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", "yyyy-MM-dd HH:mm:ss"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}", "yyyy-MM-dd'T'HH:mm:ss"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})", "yyyy-MM-dd'T'HH:mm:ssXXX"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}(Z|[+-]\d{2}:\d{2})", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"),
    (r"\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"),
    (r"\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy"),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}", "M/d/yyyy H:mm"),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}", "d/M/yyyy H:mm"),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}", "M/d/yyyy H:mm:ss"),
    (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
    (r"\d{8}", "yyyyMMdd"),
    (r"[A-Z][a-z]{2} \d{1,2} \d{4}", "MMM d yyyy"),
    (r"[A-Z][a-z]{2} \d{1,2}, \d{4}", "MMM d, yyyy"),
    (r"\d{1,2} [A-Z][a-z]{2} \d{4}", "d MMM yyyy"),
]

# Shapes that notices use besides.
NOTICE_SHAPES = [
    (r"\d{1,2} [A-Z][a-z]+ \d{4}", "d MMMM yyyy"),
    (r"[A-Z][a-z]+ \d{1,2}, \d{4}", "MMMM d, yyyy"),
    (r"[A-Z][a-z]+ \d{1,2} \d{4}", "MMMM d yyyy"),
]

# Shapes tried for a whole invoice-date column, month first (fixed values).
INVOICE_FORMATS = [
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
]
DAY_FIRST_FORMATS = ["d/M/yyyy H:mm", "d/M/yyyy H:mm:ss", "d/M/yyyy"]


def parse_date_text(col: Column, shapes: list[tuple[str, str]] = DATE_SHAPES) -> Column:
    """The date in any of the declared shapes, else NULL.

    A failed read is costly, so only formats that fit the shape of the text are tried.
    """
    text = F.trim(col)
    reads = [
        F.when(text.rlike(f"^{shape}$"), F.try_to_timestamp(text, F.lit(fmt)))
        for shape, fmt in shapes
    ]
    return F.coalesce(*reads)


def parse_utc(col: Column) -> Column:
    """ISO text with or without an offset, or one of the declared shapes, to a UTC timestamp; unreadable is NULL."""
    return F.coalesce(F.try_to_timestamp(F.trim(col)), parse_date_text(col, DATE_SHAPES + NOTICE_SHAPES))


def floor_day(col: Column) -> Column:
    return col.cast("date").cast("timestamp_ntz")


def floor_month(col: Column) -> Column:
    return F.trunc(col.cast("date"), "month").cast("timestamp_ntz")


def years_before(as_of: dt.date, years: int) -> Column:
    return F.add_months(F.lit(as_of), -12 * years)


def days_before(as_of: dt.date, days: int) -> Column:
    return F.date_sub(F.lit(as_of), days)


def week_ending_sunday(col: Column) -> Column:
    """The Sunday on or after the day."""
    return F.next_day(F.date_sub(col.cast("date"), 1), "SUN")


def year_label(col: Column) -> Column:
    return F.date_format(col, "yyyy")


def month_label(col: Column) -> Column:
    return F.date_format(col, "MM")
