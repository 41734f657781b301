"""Queries over indicator facts (country, year, indicator, value) and outbreak notices.

Each function takes plain frames, so it runs on lake tables, views or streams' outputs
alike. Orders carry tie-breakers and put NULLs last.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.dates import days_before, floor_month, years_before
from almanac.functions.numbers import percent_change
from almanac.functions.text import normal_title
from almanac.operators.ordered import with_previous
from almanac.operators.shape import latest_per_key, latest_year

_BLOCK = 1_000_000


def with_code(df: DataFrame, code: str, column: str = "indicator_code") -> DataFrame:
    return df.where(F.col(column) == code)


def _high(*columns: str) -> list[Column]:
    first, *ties = columns
    return [F.col(first).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in ties]


def latest_per_country(df: DataFrame, code: str, n: int = 100) -> DataFrame:
    """Rows of each country's newest year, highest value first. The newest may be NULL."""
    rows = latest_per_key(with_code(df, code), "country_code")
    return (
        rows.select("country_code", "year", "value")
        .orderBy(*_high("value", "country_code", "year"))
        .limit(n)
    )


def yoy_percent(df: DataFrame, code: str, country: str, n: int = 10) -> DataFrame:
    """Change in percent against the year before, newest years first."""
    rows = with_code(df, code).where(F.col("country_code") == country)
    current = rows.select("country_code", "year", F.col("value").alias("value_curr"))
    before = rows.select((F.col("year") + 1).alias("year"), F.col("value").alias("value_prev"))
    return (
        current.join(before, "year", "left")
        .select(
            "country_code", "year", "value_curr", "value_prev",
            percent_change(F.col("value_curr"), F.col("value_prev")).alias("pct_change"),
        )
        .orderBy(*_high("year", "value_curr", "value_prev"))
        .limit(n)
    )


def latest_pair(
    cases: DataFrame, case_code: str, beds: DataFrame, bed_code: str, n: int = 50
) -> DataFrame:
    """Newest cases of each country with its newest beds, most cases first."""
    left = latest_per_key(with_code(cases, case_code), "country_code").select(
        "country_code", F.col("year").alias("cholera_year"), F.col("value").alias("cholera_cases")
    )
    right = latest_per_key(with_code(beds, bed_code, "indicator_id"), "country_code").select(
        "country_code", F.col("value").alias("beds_per_1000")
    )
    return (
        left.join(right, "country_code", "left")
        .orderBy(*_high("cholera_cases", "country_code", "beds_per_1000"))
        .limit(n)
    )


def monthly_timeline(notices: DataFrame, as_of: dt.date, years: int = 3) -> DataFrame:
    """Notices per month over the years before `as_of`."""
    recent = notices.where(F.col("publication_date") >= years_before(as_of, years))
    return (
        recent.groupBy(floor_month(F.col("publication_date")).alias("month"))
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy("month")
    )


def recent_with_latest(
    notices: DataFrame, df: DataFrame, code: str, as_of: dt.date, days: int = 90, n: int = 200
) -> DataFrame:
    """Notices of the last days with the country's newest indicator value, newest first."""
    recent = notices.where(F.col("publication_date") >= days_before(as_of, days))
    newest = latest_per_key(with_code(df, code), "country_code").select(
        F.col("country_code").alias("country_iso3"), F.col("value").alias("malaria_value")
    )
    return (
        recent.select("publication_date", "title", "country_iso3")
        .join(newest, "country_iso3", "left")
        .select("publication_date", "title", "country_iso3", "malaria_value")
        .orderBy(*_high("publication_date", "title", "country_iso3", "malaria_value"))
        .limit(n)
    )


def change_between_years(df: DataFrame, code: str, start: int, end: int, n: int = 50) -> DataFrame:
    """Change in percent from the start to the end year for countries with an end value row."""
    rows = with_code(df, code)
    base = rows.where(F.col("year") == start).select("country_code", F.col("value").alias("value_start"))
    last = rows.where(F.col("year") == end).select("country_code", F.col("value").alias("value_end"))
    return (
        last.join(base, "country_code", "left")
        .withColumn("pct_change", percent_change(F.col("value_end"), F.col("value_start")))
        .orderBy(*_high("pct_change", "country_code", "value_end", "value_start"))
        .limit(n)
    )


def mean_since(df: DataFrame, code: str, first_year: Column, name: str, n: int | None = None) -> DataFrame:
    """Mean per country over the years from `first_year` on, highest first."""
    means = (
        with_code(df, code)
        .where(F.col("year") >= first_year)
        .groupBy("country_code")
        .agg(F.avg("value").alias(name))
        .orderBy(*_high(name, "country_code"))
    )
    return means if n is None else means.limit(n)


def mean_last_years(df: DataFrame, code: str, as_of: dt.date, years: int = 5, n: int = 25) -> DataFrame:
    """Years counted back from the reference date: with 5 this covers six calendar years."""
    return mean_since(df, code, F.lit(as_of.year - years), "avg_malaria", n)


def mean_last_years_of_data(df: DataFrame, code: str, years: int = 5) -> DataFrame:
    """Years counted back from the newest year in the data."""
    newest = with_code(df, code).agg((F.max("year") - (years - 1)).alias("first_year"))
    return mean_since(df, code, newest.scalar(), "avg_malaria_5yrs")


def commonest_titles(notices: DataFrame, n: int = 20) -> DataFrame:
    return (
        notices.groupBy(normal_title(F.col("title")).alias("title_text"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .orderBy(*_high("occurrences", "title_text"))
        .limit(n)
    )


def most_recent(notices: DataFrame, n: int = 20) -> DataFrame:
    return (
        notices.select("publication_date", "title", "source_url")
        .orderBy(*_high("publication_date", "title", "source_url"))
        .limit(n)
    )


def global_latest(df: DataFrame, code: str) -> DataFrame:
    """Rows of the newest year over all countries."""
    return latest_year(with_code(df, code)).select(
        "country_code", "year", F.col("value").alias("life_expectancy")
    )


def top_total(df: DataFrame, code: str, n: int = 20) -> DataFrame:
    """Countries with the largest sum over all years."""
    return (
        with_code(df, code)
        .groupBy("country_code")
        .agg(F.sum("value").alias("cholera_cases"))
        .orderBy(*_high("cholera_cases", "country_code"))
        .limit(n)
    )


def yoy_difference(df: DataFrame, code: str, country: str) -> DataFrame:
    """Difference to the row before in year order for one country.

    Rows of a year are ordered by value. Equal rows are counted first and only the
    distinct ones are ordered, so neither one country nor one repeated row has to fit a
    task; each repeat follows its equal, with a difference of 0.
    """
    rows = with_code(df, code).where(F.col("country_code") == country)
    counted = rows.groupBy("year", "value").agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col("year"), F.col("value").asc_nulls_last()]
    stepped = with_previous(counted, order, "value", "_before")
    last_block = F.floor((F.col("_n") - 1) / _BLOCK)
    blocks = stepped.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    start = F.col("_block") * _BLOCK
    copies = blocks.withColumn(
        "_copy",
        F.explode(F.sequence(start + 1, F.least(start + _BLOCK, F.col("_n")))),
    )
    change = F.when(F.col("_copy") == 1, F.col("value") - F.col("_before")).otherwise(
        F.col("value") - F.col("value")
    )
    return copies.select("year", F.col("value").alias("malaria_incidence"), change.alias("yoy_change"))


def same_year(cases: DataFrame, case_code: str, beds: DataFrame, bed_code: str) -> DataFrame:
    """Cases and beds of the same country and year."""
    left = with_code(cases, case_code).select(
        "country_code", "year", F.col("value").alias("cholera_cases")
    )
    right = with_code(beds, bed_code, "indicator_id").select(
        "country_code", "year", F.col("value").alias("beds_per_1000")
    )
    return left.join(right, ["country_code", "year"])


def yearly_count(notices: DataFrame) -> DataFrame:
    return (
        notices.groupBy(F.year("publication_date").alias("year"))
        .agg(F.count(F.lit(1)).alias("outbreak_count"))
        .orderBy(F.col("year").asc_nulls_last())
    )


def notices_with_same_year(notices: DataFrame, df: DataFrame, code: str) -> DataFrame:
    """All notices with the country's indicator value of the notice's year, newest first.

    The whole result is sorted, so further columns follow the date: they let the range
    partitioner split a day that holds much of the data.
    """
    values = with_code(df, code).select(
        F.col("country_code").alias("country_iso3"), F.col("year").alias("_year"),
        F.col("value").alias("malaria_incidence"),
    )
    dated = notices.select(
        "title", "publication_date", "country_iso3", F.year("publication_date").alias("_year")
    )
    return (
        dated.join(values, ["country_iso3", "_year"], "left")
        .orderBy(*_high("publication_date", "title", "country_iso3", "malaria_incidence"))
        .select("title", "publication_date", "malaria_incidence")
    )


def two_year_pivot(df: DataFrame, code: str, start: int, end: int) -> DataFrame:
    """Largest value in each of two years side by side, for countries with either year."""
    rows = with_code(df, code).where(F.col("year").isin(start, end))
    value = F.col("value")
    wide = rows.groupBy("country_code").agg(
        F.max(F.when(F.col("year") == end, value)).alias("value_end"),
        F.max(F.when(F.col("year") == start, value)).alias("value_start"),
    )
    change = F.try_divide(F.col("value_end") - F.col("value_start"), F.col("value_start")) * 100
    return wide.withColumn("pct_change", change)
