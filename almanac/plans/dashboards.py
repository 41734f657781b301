"""Dashboard datasets of the health lake, and the registry that binds them to views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.operators.shape import (
    between,
    clean_numeric,
    last_values,
    latest_value_per_key,
    latest_year,
    pivot_mean,
    require_columns,
    top,
)

# The seven countries of the regional panel (fixed values).
PANEL = ["NGA", "GHA", "KEN", "ETH", "UGA", "TZA", "SEN"]
HIGHLIGHT = "NGA"
PANEL_YEARS = (2000, 2022)


def _in_order(df: DataFrame) -> DataFrame:
    """By country and year; the value breaks ties, so a hot year can be split over tasks."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in ("country_code", "year", "value")])


def global_trend(df: DataFrame) -> DataFrame:
    """Mean over countries per year."""
    return df.groupBy("year").agg(F.avg("value").alias("value")).orderBy("year")


def top_series(df: DataFrame, n: int = 5) -> DataFrame:
    """All rows of the n countries with the highest mean in the newest year."""
    means = latest_year(df).groupBy("country_code").agg(F.avg("value").alias("mean"))
    best = top(
        means.where("mean is not null"), n, F.col("mean").desc(), F.col("country_code").asc()
    )
    return _in_order(df.join(best.select("country_code"), "country_code", "left_semi"))


def heat_table(df: DataFrame) -> DataFrame:
    require_columns(df, ["country_code", "year", "value"], "heat table")
    return pivot_mean(df, "country_code", "year", "value")


def country_series(df: DataFrame, country: str = HIGHLIGHT) -> DataFrame:
    return _in_order(df.where(F.col("country_code") == country))


def panel_series(df: DataFrame, countries: list[str] | None = None) -> DataFrame:
    return _in_order(df.where(F.col("country_code").isin(countries or PANEL)))


def panel_mean(df: DataFrame, countries: list[str] | None = None) -> DataFrame:
    panel = df.where(F.col("country_code").isin(countries or PANEL))
    return panel.groupBy("year").agg(F.avg("value").alias("ssa_avg")).orderBy("year")


def highlight_vs_peers(
    countries: DataFrame,
    reference: DataFrame,
    highlight: str = HIGHLIGHT,
    years: tuple[int, int] = PANEL_YEARS,
) -> DataFrame:
    """Highlighted country, its peers and the reference line in one long frame by role."""
    require_columns(countries, ["country_code", "year", "value"], "highlight")
    require_columns(reference, ["year", "ssa_avg"], "highlight")
    lines = between(countries, "year", *years)
    role = F.when(F.col("country_code") == highlight, "highlight").otherwise("peer")
    line = between(reference, "year", *years)
    return lines.select(role.alias("role"), "country_code", "year", "value").unionByName(
        line.select(
            F.lit("reference").alias("role"), F.lit(None).cast("string").alias("country_code"),
            "year", F.col("ssa_avg").alias("value"),
        )
    )


def latest_map(df: DataFrame) -> DataFrame:
    """One newest value per country."""
    return latest_value_per_key(df, "country_code")


def top_latest(df: DataFrame, text: str, n: int = 10) -> DataFrame:
    """Highest newest values among indicators whose code contains the text."""
    rows = df.where(F.coalesce(F.col("indicator_code").contains(text), F.lit(False)))
    return top(
        latest_value_per_key(rows, "country_code"), n,
        F.col("value").desc_nulls_last(), F.col("country_code").asc(),
    )


def many_cases_few_beds(
    cases: DataFrame, beds: DataFrame, more_than: float = 500, n: int = 10
) -> DataFrame:
    """Countries whose newest cases exceed the limit, fewest newest beds first."""
    newest_cases = last_values(cases, "country_code", "year", ["value"]).select(
        "country_code", F.col("value").alias("cholera_cases")
    )
    newest_beds = latest_value_per_key(beds, "country_code").select(
        "country_code", F.col("value").alias("value_beds")
    )
    joined = newest_cases.join(newest_beds, "country_code").where(F.col("cholera_cases") > more_than)
    return top(joined, n, F.col("value_beds").asc_nulls_last(), F.col("country_code").asc())


Tables = dict[str, DataFrame]

# Dataset name -> builder over the clean tables.
DATASETS: dict[str, Callable[[Tables], DataFrame]] = {
    "life_expectancy": lambda t: global_trend(t["life_expectancy"]),
    "malaria_incidence_top_countries": lambda t: top_series(t["malaria_incidence"]),
    "nigeria_physicians": lambda t: country_series(t["wb_physicians_per_1000"]),
    "life_expectancy_ssa": lambda t: panel_series(t["life_expectancy"]),
    "life_expectancy_ssa_avg": lambda t: panel_mean(t["life_expectancy"]),
}

# View name -> how its frame is made from the datasets.
VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "life_expectancy_trend": lambda d: clean_numeric(d["life_expectancy"], ["year", "value"]),
    "malaria_heatmap": lambda d: heat_table(d["malaria_incidence_top_countries"]),
    "malaria_trends_top": lambda d: clean_numeric(
        d["malaria_incidence_top_countries"], ["year", "value"]
    ),
    "nigeria_physicians": lambda d: clean_numeric(d["nigeria_physicians"], ["year", "value"]),
    "nigeria_vs_ssa_life_expectancy": lambda d: highlight_vs_peers(
        d["life_expectancy_ssa"], d["life_expectancy_ssa_avg"]
    ),
}


def load_all(tables: Tables) -> Tables:
    """All datasets by name; nothing runs until one is used."""
    return {name: build(tables) for name, build in DATASETS.items()}


def build_views(datasets: Tables) -> Tables:
    return {name: build(datasets) for name, build in VIEWS.items()}
