"""Independent SQL for the indicator and notice queries, written for DuckDB."""

from __future__ import annotations

from almanac.plans.views import AS_OF, BEDS, CHOLERA, COUNTRY, LIFE, MALARIA, REGION

FIRST, LAST = 1996, 2000


def _indicator(extra: str = "") -> str:
    return f"""indicator AS (
  SELECT n_name AS country_code, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS indicator_code,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_name, year(o_orderdate), o_orderpriority{extra})"""


ONE = _indicator()
MANY = _indicator(", o_orderstatus")
BED = f"""beds AS (
  SELECT n_name AS country_code, CAST(year(l_shipdate) AS INTEGER) AS year, '{BEDS}' AS indicator_id,
         SUM(l_quantity) AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY n_name, year(l_shipdate))"""
NOTICE = """outbreaks AS (
  SELECT '  ' || o_orderpriority AS title, n_name AS country_iso3, o_orderdate AS publication_date,
         '/item/' || CAST(o_orderkey AS VARCHAR) AS source_url
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
TITLES = """titles AS (
  SELECT o_orderkey, CASE o_orderkey % 7
           WHEN 0 THEN 'Cholera - ' || n_name
           WHEN 1 THEN 'Cholera – situation in ' || lower(n_name)
           WHEN 2 THEN 'Measles update 3 — ' || n_name
           WHEN 3 THEN 'Measles cases reported in ' || place
           WHEN 4 THEN 'Ebola - week 4 - ' || n_name || ' '
           WHEN 5 THEN '  ' || o_orderpriority
           ELSE ' update' END AS title,
         o_orderkey % 7 AS shape, n_name, n_nationkey, place, r_regionkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN (SELECT r_regionkey, array_to_string(list_transform(string_split(r_name, ' '),
          lambda w: upper(w[1]) || lower(w[2:])), ' ') AS place FROM region) r ON n_regionkey = r_regionkey)"""


def _ranked(code: str, source: str = "indicator", column: str = "indicator_code") -> str:
    return f"""(SELECT * FROM {source} WHERE {column} = '{code}'
  QUALIFY rank() OVER (PARTITION BY country_code ORDER BY year DESC) = 1)"""


_REGION = ", ".join(f"'{c}'" for c in REGION)
_TOP5 = f"""best AS (
  SELECT country_code FROM indicator WHERE indicator_code = '{MALARIA}'
    AND year = (SELECT max(year) FROM indicator WHERE indicator_code = '{MALARIA}')
  GROUP BY 1 ORDER BY avg(value) DESC, country_code LIMIT 5)"""

ORACLE = {
    "markup_text": """SELECT o_orderkey, o_orderpriority || ' café & ' || o_orderstatus || ' var tag = "<p>"; #' || o_orderkey AS text
FROM orders""",
    "latest_per_country": f"""WITH {MANY} SELECT country_code, year, value FROM {_ranked(LIFE)}
ORDER BY value DESC, country_code LIMIT 100""",
    "top20_latest": f"""WITH {MANY} SELECT country_code, year, value FROM {_ranked(CHOLERA)}
ORDER BY value DESC, country_code LIMIT 20""",
    "yoy_pct_change": f"""WITH {ONE},
one AS (SELECT *, lag(value) OVER (ORDER BY year) AS v, lag(year) OVER (ORDER BY year) AS y FROM indicator
        WHERE indicator_code = '{MALARIA}' AND country_code = '{COUNTRY}')
SELECT country_code, year, value AS value_curr, CASE WHEN y = year - 1 THEN v END AS value_prev,
       round(CASE WHEN y = year - 1 AND v <> 0 THEN 100.0 * (value - v) / v END, 4) AS pct_change
FROM one ORDER BY year DESC LIMIT 10""",
    "latest_a_vs_latest_b": f"""WITH {MANY}, {BED}
SELECT c.country_code, c.year AS cholera_year, c.value AS cholera_cases, b.value AS beds_per_1000
FROM {_ranked(CHOLERA)} c LEFT JOIN {_ranked(BEDS, "beds", "indicator_id")} b ON c.country_code = b.country_code
ORDER BY c.value DESC, c.country_code LIMIT 50""",
    "monthly_timeline": f"""WITH {NOTICE}
SELECT date_trunc('month', publication_date) AS month, COUNT(*) AS events FROM outbreaks
WHERE publication_date >= DATE '{AS_OF}' - INTERVAL 3 YEAR GROUP BY 1 ORDER BY 1""",
    "recent_events_with_latest": f"""WITH {ONE}, {NOTICE}
SELECT publication_date, title, country_iso3, m.value AS malaria_value
FROM outbreaks LEFT JOIN {_ranked(MALARIA)} m ON m.country_code = country_iso3
WHERE publication_date >= DATE '{AS_OF}' - INTERVAL 90 DAY
ORDER BY publication_date DESC, title, country_iso3 LIMIT 200""",
    "pct_change_two_years": f"""WITH {MANY}
SELECT e.country_code, e.value AS value_end, s.value AS value_start,
       round(100.0 * (e.value - s.value) / nullif(s.value, 0), 4) AS pct_change
FROM (SELECT * FROM indicator WHERE indicator_code = '{LIFE}' AND year = {LAST}) e
LEFT JOIN (SELECT * FROM indicator WHERE indicator_code = '{LIFE}' AND year = {FIRST}) s
  ON e.country_code = s.country_code
ORDER BY 100.0 * (e.value - s.value) / nullif(s.value, 0) DESC NULLS LAST, 1, 2, 3 LIMIT 50""",
    "avg_last_n_years": f"""WITH {ONE}
SELECT country_code, round(avg(value), 4) AS avg_malaria FROM indicator
WHERE indicator_code = '{MALARIA}' AND year >= {AS_OF.year - 5}
GROUP BY 1 ORDER BY avg(value) DESC, 1 LIMIT 25""",
    "commonest_titles": f"""WITH {NOTICE}
SELECT lower(trim(title)) AS title_text, COUNT(*) AS occurrences FROM outbreaks GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 20""",
    "most_recent": f"""WITH {NOTICE} SELECT publication_date, title, source_url FROM outbreaks
ORDER BY publication_date DESC, title, source_url LIMIT 20""",
    "global_latest_year": f"""WITH {ONE} SELECT country_code, year, value AS life_expectancy FROM indicator
WHERE indicator_code = '{LIFE}' QUALIFY year = max(year) OVER ()""",
    "top20_total": f"""WITH {ONE} SELECT country_code, round(SUM(value), 2) AS cholera_cases FROM indicator
WHERE indicator_code = '{CHOLERA}' GROUP BY 1 ORDER BY SUM(value) DESC, 1 LIMIT 20""",
    "yoy_lag_diff": f"""WITH {MANY}
SELECT year, value AS malaria_incidence,
       round(value - lag(value) OVER (ORDER BY year, value), 2) AS yoy_change
FROM indicator WHERE indicator_code = '{MALARIA}' AND country_code = '{COUNTRY}'""",
    "same_year_join": f"""WITH {ONE}, {BED}
SELECT country_code, year, i.value AS cholera_cases, b.value AS beds_per_1000
FROM indicator i JOIN beds b USING (country_code, year) WHERE indicator_code = '{CHOLERA}'""",
    "yearly_count": f"""WITH {NOTICE}
SELECT CAST(year(publication_date) AS INTEGER) AS year, COUNT(*) AS outbreak_count FROM outbreaks GROUP BY 1""",
    "events_with_same_year_value": f"""WITH {ONE}, {NOTICE}
SELECT title, publication_date, m.value AS malaria_incidence FROM outbreaks
LEFT JOIN indicator m ON year(publication_date) = m.year AND country_iso3 = m.country_code
  AND m.indicator_code = '{MALARIA}'""",
    "pivot_two_years_filter": f"""WITH {MANY},
wide AS (SELECT country_code, max(value) FILTER (WHERE year = {LAST}) AS value_end,
                max(value) FILTER (WHERE year = {FIRST}) AS value_start
         FROM indicator WHERE indicator_code = '{LIFE}' AND year IN ({FIRST}, {LAST}) GROUP BY 1)
SELECT *, round((value_end - value_start) / value_start * 100, 4) AS pct_change FROM wide""",
    "avg_last_5_by_max_year": f"""WITH {ONE}, m AS (SELECT * FROM indicator WHERE indicator_code = '{MALARIA}')
SELECT country_code, round(avg(value), 4) AS avg_malaria_5yrs FROM m
WHERE year >= (SELECT max(year) - 4 FROM m) GROUP BY 1""",
    "global_trend": f"""WITH {ONE} SELECT year, round(avg(value), 4) AS value FROM indicator
WHERE indicator_code = '{LIFE}' GROUP BY 1""",
    "topk_series": f"""WITH {ONE}, {_TOP5} SELECT country_code, year, indicator_code, value FROM indicator
WHERE indicator_code = '{MALARIA}' AND country_code IN (SELECT country_code FROM best)""",
    "heatmap_pivot": f"""WITH {MANY}, {_TOP5}
SELECT country_code, {", ".join(f'round(avg(value) FILTER (WHERE year = {y}), 4) AS "{y}"' for y in range(1995, 2002))}
FROM indicator WHERE indicator_code = '{MALARIA}' AND country_code IN (SELECT country_code FROM best) GROUP BY 1""",
    "country_series": f"WITH {BED} SELECT * FROM beds WHERE country_code = '{COUNTRY}'",
    "region_series": f"""WITH {ONE} SELECT * FROM indicator
WHERE indicator_code = '{LIFE}' AND country_code IN ({_REGION})""",
    "region_avg": f"""WITH {ONE} SELECT year, round(avg(value), 4) AS ssa_avg FROM indicator
WHERE indicator_code = '{LIFE}' AND country_code IN ({_REGION}) GROUP BY 1""",
    "highlight_vs_peers": f"""WITH {ONE}, panel AS (SELECT * FROM indicator WHERE indicator_code = '{LIFE}'
  AND country_code IN ({_REGION}) AND year BETWEEN {FIRST} AND {LAST})
SELECT CASE WHEN country_code = '{COUNTRY}' THEN 'highlight' ELSE 'peer' END AS role, country_code, year,
       round(value, 4) AS value FROM panel
UNION ALL SELECT 'reference', NULL, year, round(avg(value), 4) FROM panel GROUP BY year""",
    "latest_map": f"""WITH {MANY} SELECT country_code, year, min(value) AS value FROM {_ranked(LIFE)} GROUP BY 1, 2""",
    "top10_latest_containing": f"""WITH {MANY}, newest AS (
  SELECT country_code, year, min(value) AS value FROM indicator WHERE indicator_code LIKE '%HIGH%' GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY country_code ORDER BY year DESC) = 1)
SELECT * FROM newest ORDER BY value DESC, country_code LIMIT 10""",
    "high_cases_low_beds": f"""WITH {ONE}, {BED}
SELECT c.country_code, c.value AS cholera_cases, b.value AS value_beds
FROM {_ranked(CHOLERA)} c JOIN {_ranked(BEDS, "beds", "indicator_id")} b ON c.country_code = b.country_code
WHERE c.value > 500 ORDER BY b.value, c.country_code LIMIT 10""",
    "union_indicators": f"""WITH {ONE} SELECT * FROM indicator
WHERE indicator_code IN ('{LIFE}', '{MALARIA}', '{CHOLERA}')""",
    "source_priority": f"""WITH {ONE}, many AS (
  SELECT n_name AS country_code, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS indicator_code,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_name, year(o_orderdate), o_orderpriority, o_orderstatus)
SELECT *, 'who' AS source FROM indicator WHERE indicator_code IN ('{LIFE}', '{CHOLERA}')
UNION ALL SELECT *, 'owid' FROM many WHERE indicator_code NOT IN ('{LIFE}', '{CHOLERA}')""",
    "drop_aggregates": f"WITH {ONE} SELECT * FROM indicator WHERE country_code NOT IN ('NATION_0', 'NATION_24')",
    "last_values_per_country": f"""WITH {MANY}
SELECT country_code, year, max(value) AS value, max(indicator_code) AS indicator_code
FROM (SELECT * FROM indicator QUALIFY rank() OVER (PARTITION BY country_code ORDER BY year DESC) = 1)
GROUP BY 1, 2""",
    "supported_functions": """SELECT event_type, CAST(1 AS BIGINT) AS types, event_type AS any_type,
       min(ts) - INTERVAL 3 DAY AS three_days_before_first,
       date_sub('hour', min(ts), max(ts)) AS hours, CAST(4 AS INTEGER) AS steps,
       make_timestamp(max(event_id) * 1000000) AS from_epoch, min(ts + INTERVAL 1 YEAR) AS next_year
FROM events GROUP BY 1""",
    "disease_of_title": f"""WITH {TITLES}
SELECT o_orderkey, CASE WHEN shape IN (0, 1) THEN 'Cholera' WHEN shape IN (2, 3) THEN 'Measles'
  WHEN shape = 4 THEN 'Ebola' WHEN shape = 5 THEN trim(string_split(title, '-')[1]) END AS disease FROM titles""",
    "country_of_title": f"""WITH {TITLES}
SELECT o_orderkey, CASE WHEN shape IN (0, 1, 2, 4) THEN n_name WHEN shape = 3 THEN place END AS country,
       CASE WHEN shape IN (0, 1, 2, 4) THEN 'n' || n_nationkey WHEN shape = 3 THEN 'r' || r_regionkey END AS country_iso2,
       CASE WHEN shape IN (0, 1, 2, 4) THEN 'nn' || n_nationkey WHEN shape = 3 THEN 'rr' || r_regionkey END AS country_iso3
FROM titles""",
}
