"""Registered queries over indicators and outbreak notices."""

from __future__ import annotations

from pyspark.sql import functions as F

from almanac.functions import compat
from almanac.functions.countries import with_country
from almanac.functions.text import country_candidates, disease_from_title, html_to_text
from almanac.operators import indicators as ind
from almanac.operators import shape
from almanac.plans import dashboards as dash
from almanac.session import checkpointed
from almanac.plans.views import (
    AS_OF, BEDS, CHOLERA, COUNTRY, LIFE, MALARIA, REGION,
    beds, indicator, notices, outbreaks, places, table,
)

QUERIES = {}
FIRST, LAST = 1996, 2000


def _facts(spark, sf_dir, code=None, repeated=False):
    """Indicator facts stored once, for queries that read them more than once.

    The code is filtered first, so it reaches the scan.
    """
    facts = indicator(spark, sf_dir, repeated)
    return checkpointed(facts if code is None else ind.with_code(facts, code))


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query
def latest_per_country(spark, sf_dir):
    return ind.latest_per_country(_facts(spark, sf_dir, LIFE, repeated=True), LIFE)


@query
def top20_latest(spark, sf_dir):
    return ind.latest_per_country(_facts(spark, sf_dir, CHOLERA, repeated=True), CHOLERA, n=20)


@query
def yoy_pct_change(spark, sf_dir):
    return _rounded(ind.yoy_percent(_facts(spark, sf_dir, MALARIA), MALARIA, COUNTRY), "pct_change")


@query
def latest_a_vs_latest_b(spark, sf_dir):
    cases = _facts(spark, sf_dir, CHOLERA, repeated=True)
    return ind.latest_pair(cases, CHOLERA, checkpointed(beds(spark, sf_dir)), BEDS)


@query
def monthly_timeline(spark, sf_dir):
    return ind.monthly_timeline(outbreaks(spark, sf_dir), AS_OF)


@query
def recent_events_with_latest(spark, sf_dir):
    facts = _facts(spark, sf_dir, MALARIA)
    return ind.recent_with_latest(outbreaks(spark, sf_dir), facts, MALARIA, AS_OF)


@query
def pct_change_two_years(spark, sf_dir):
    facts = _facts(spark, sf_dir, LIFE, repeated=True)
    return _rounded(ind.change_between_years(facts, LIFE, FIRST, LAST), "pct_change")


@query
def avg_last_n_years(spark, sf_dir):
    return _rounded(ind.mean_last_years(indicator(spark, sf_dir), MALARIA, AS_OF), "avg_malaria")


@query
def commonest_titles(spark, sf_dir):
    return ind.commonest_titles(outbreaks(spark, sf_dir))


@query
def most_recent(spark, sf_dir):
    return ind.most_recent(outbreaks(spark, sf_dir))


@query
def global_latest_year(spark, sf_dir):
    return ind.global_latest(_facts(spark, sf_dir, LIFE), LIFE)


@query
def top20_total(spark, sf_dir):
    return _rounded(ind.top_total(indicator(spark, sf_dir), CHOLERA), "cholera_cases", digits=2)


@query
def yoy_lag_diff(spark, sf_dir):
    facts = indicator(spark, sf_dir, repeated=True)
    return _rounded(ind.yoy_difference(facts, MALARIA, COUNTRY), "yoy_change", digits=2)


@query
def same_year_join(spark, sf_dir):
    return ind.same_year(indicator(spark, sf_dir), CHOLERA, beds(spark, sf_dir), BEDS)


@query
def yearly_count(spark, sf_dir):
    return ind.yearly_count(outbreaks(spark, sf_dir))


@query
def events_with_same_year_value(spark, sf_dir):
    return ind.notices_with_same_year(outbreaks(spark, sf_dir), indicator(spark, sf_dir), MALARIA)


@query
def pivot_two_years_filter(spark, sf_dir):
    facts = indicator(spark, sf_dir, repeated=True)
    return _rounded(ind.two_year_pivot(facts, LIFE, FIRST, LAST), "pct_change")


@query
def avg_last_5_by_max_year(spark, sf_dir):
    means = ind.mean_last_years_of_data(_facts(spark, sf_dir, MALARIA), MALARIA)
    return _rounded(means, "avg_malaria_5yrs")


# ---- dashboard datasets ----------------------------------------------------------------


@query
def global_trend(spark, sf_dir):
    return _rounded(dash.global_trend(ind.with_code(indicator(spark, sf_dir), LIFE)), "value")


@query
def topk_series(spark, sf_dir):
    return dash.top_series(_facts(spark, sf_dir, MALARIA))


@query
def heatmap_pivot(spark, sf_dir):
    facts = _facts(spark, sf_dir, MALARIA, repeated=True)
    table_ = dash.heat_table(dash.top_series(facts))
    return _rounded(table_, *[c for c in table_.columns if c != "country_code"])


@query
def country_series(spark, sf_dir):
    return dash.country_series(beds(spark, sf_dir), COUNTRY)


@query
def region_series(spark, sf_dir):
    return dash.panel_series(ind.with_code(indicator(spark, sf_dir), LIFE), REGION)


@query
def region_avg(spark, sf_dir):
    facts = ind.with_code(indicator(spark, sf_dir), LIFE)
    return _rounded(dash.panel_mean(facts, REGION), "ssa_avg")


@query
def highlight_vs_peers(spark, sf_dir):
    facts = _facts(spark, sf_dir, LIFE)
    lines = dash.highlight_vs_peers(
        dash.panel_series(facts, REGION), dash.panel_mean(facts, REGION), COUNTRY, (FIRST, LAST)
    )
    return _rounded(lines, "value")


@query
def latest_map(spark, sf_dir):
    return dash.latest_map(ind.with_code(indicator(spark, sf_dir, repeated=True), LIFE))


@query
def top10_latest_containing(spark, sf_dir):
    return dash.top_latest(indicator(spark, sf_dir, repeated=True), "HIGH")


@query
def high_cases_low_beds(spark, sf_dir):
    cases = ind.with_code(indicator(spark, sf_dir), CHOLERA)
    return dash.many_cases_few_beds(cases, beds(spark, sf_dir))


@query
def union_indicators(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    parts = [ind.with_code(facts, code) for code in (LIFE, MALARIA, CHOLERA)]
    return shape.union_all(parts)


@query
def source_priority(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    primary = facts.where(F.col("indicator_code").isin(LIFE, CHOLERA))
    return shape.first_available(
        {"who": primary, "owid": _facts(spark, sf_dir, repeated=True)}, "indicator_code"
    )


@query
def drop_aggregates(spark, sf_dir):
    return shape.drop_aggregates(indicator(spark, sf_dir), codes=["NATION_0", "NATION_24"])


@query
def last_values_per_country(spark, sf_dir):
    return shape.last_values(
        indicator(spark, sf_dir, repeated=True), "country_code", "year", ["value", "indicator_code"]
    )


@query
def supported_functions(spark, sf_dir):
    """The SQL functions lake users rely on, per event type."""
    events = table(spark, sf_dir, "events")
    moved = compat.date_add("day", -3, F.col("ts"))
    return events.groupBy("event_type").agg(
        compat.approx_distinct("event_type").alias("types"),
        compat.arbitrary("event_type").alias("any_type"),
        F.min(moved).alias("three_days_before_first"),
        compat.date_diff("hour", F.min("ts"), F.max("ts")).alias("hours"),
        F.max(compat.cardinality(compat.sequence(F.lit(1), F.lit(10), F.lit(3)))).alias("steps"),
        F.max(compat.from_unixtime(F.col("event_id")).cast("timestamp_ntz")).alias("from_epoch"),
        F.min(compat.date_add("year", 1, F.col("ts"))).alias("next_year"),
    )


# ---- notice texts ----------------------------------------------------------------------


@query
def html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", html_to_text("html").alias("text"))


@query
def markup_text(spark, sf_dir):
    """Markup made from the orders, so that its text is known."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    markup = F.concat(
        F.lit('<!DOCTYPE html><div title="a > b">'), "o_orderpriority", F.lit("</div><!-- <p>"), key,
        F.lit("</p> --><p class='x'>caf&eacute; &amp; "), "o_orderstatus",
        F.lit('</p><script>var tag = "<p>";</script><br/>#'), key, F.lit(" <span unfinished"),
    )
    return orders.select("o_orderkey", html_to_text(markup).alias("text"))


@query
def disease_of_title(spark, sf_dir):
    return notices(spark, sf_dir).select("o_orderkey", disease_from_title(F.col("title")).alias("disease"))


@query
def country_of_title(spark, sf_dir):
    titles = notices(spark, sf_dir).select("o_orderkey", "title")
    found = with_country(titles, "title", country_candidates(F.col("title")), places(spark, sf_dir), "c")
    return found.select(
        "o_orderkey", F.col("c.name").alias("country"), F.col("c.alpha_2").alias("country_iso2"),
        F.col("c.alpha_3").alias("country_iso3"),
    )
