"""Independent SQL for the queries over whole runs, written for DuckDB."""

from __future__ import annotations

from almanac.plans.health_oracle import BED, ONE
from almanac.plans.lake_oracle import CLEAN, CODED
from almanac.plans.retail_oracle import LINES, PRODUCTS

ORACLE = {
    "lake_functions": """SELECT event_type, date_sub('hour', min(ts), max(ts)) AS hours,
       min(ts + to_days(CAST(user_id % 5 AS INTEGER))) AS first_moved, CAST(4 AS INTEGER) AS steps,
       CAST(3 AS INTEGER) AS three, event_type AS any_type, CAST(1 AS BIGINT) AS types,
       make_timestamp(max(event_id) * 1000000) AS from_epoch, 'arbitrary(it''s) array[1]' AS literal
FROM events WHERE ts >= TIMESTAMP '2024-01-04 00:00:00' GROUP BY event_type""",
    "repaired_partitions": f"""WITH {CODED}
SELECT year, count(*) AS n, max(o_totalprice) AS highest, CAST(NULL AS BIGINT) AS before_repair
FROM coded WHERE year < 2000 GROUP BY year
UNION ALL SELECT 2030, count(*), max(o_totalprice) * 2, 0 FROM coded WHERE year >= 2000 HAVING count(*) > 0""",
    "consumer_ledger": f"""WITH {CLEAN}
SELECT 'counts' AS consumer, year, count(*) AS n, CAST(1 AS BIGINT) AS runs FROM newest GROUP BY year
UNION ALL SELECT 'highest', year, count(DISTINCT code), 1 FROM newest GROUP BY year""",
    "stored_model_scores": "SELECT c_custkey, true AS same, true AS a_probability FROM customer",
    "merged_user_counts": """WITH ranges(range, first, last) AS (VALUES
  ('week', DATE '2024-01-01', DATE '2024-01-07'), ('middle', DATE '2024-01-08', DATE '2024-01-20'),
  ('month', DATE '2024-01-01', DATE '2024-01-31'))
SELECT range, count(DISTINCT user_id) AS exact, true AS within_bound
FROM events JOIN ranges ON CAST(ts AS DATE) BETWEEN first AND last GROUP BY range""",
    "retail_job_outputs": f"""WITH {PRODUCTS}
SELECT 'products' AS name, count(*) AS n, true AS as_stated FROM products
UNION ALL SELECT 'ranked', count(*), true FROM products
UNION ALL SELECT 'rfm', count(DISTINCT CustomerID), true FROM lines
  WHERE CustomerID IS NOT NULL AND NOT is_cancellation AND NOT is_adjustment""",
    "run_records": """SELECT event_type, count(*) AS n, 'events_by_type' AS query,
       (SELECT count(DISTINCT event_type) FROM events) AS metric_rows, CAST(2 AS INTEGER) AS outputs,
       CAST(2 AS BIGINT) AS runs, (SELECT CAST(count(DISTINCT event_type) AS BIGINT) FROM events) AS run_rows,
       'nothing to do' AS last_outcome FROM events GROUP BY event_type""",
    "gho_filtered": f"""WITH {CODED} SELECT o_orderkey, code AS country_code, year, o_totalprice AS value,
       o_orderpriority AS indicator_code FROM coded WHERE o_orderkey % 5 <> 0 AND year >= 1998""",
    "trimmed_numbers": """SELECT c_custkey, try_cast(c_name AS DOUBLE) AS phone,
       CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS balance FROM customer""",
    "named_product_key": "SELECT l_partkey AS product, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_partkey",
    "single_customer_ranks": f"""WITH {LINES} SELECT max(CustomerID) AS "CustomerID", CAST(3 AS INTEGER) AS "R_rank",
       CAST(2 AS INTEGER) AS "F_rank", CAST(2 AS INTEGER) AS "M_rank", CAST(322 AS INTEGER) AS "RFM_score"
FROM lines WHERE CustomerID IS NOT NULL AND NOT is_cancellation AND NOT is_adjustment""",
    "dashboard_run": f"""WITH {ONE}, {BED}, life AS (SELECT * FROM indicator WHERE indicator_code = '1-URGENT'),
malaria AS (SELECT * FROM indicator WHERE indicator_code = '3-MEDIUM'),
panel AS (SELECT * FROM life WHERE TRY_CAST(regexp_extract(country_code, '(\\d+)$', 1) AS INTEGER) < 7),
best AS (SELECT country_code FROM malaria WHERE year = (SELECT max(year) FROM malaria WHERE year IS NOT NULL)
  GROUP BY country_code HAVING avg(value) IS NOT NULL
  ORDER BY avg(value) DESC, CASE regexp_extract(country_code, '(\\d+)$', 1) WHEN '0' THEN 'NGA' WHEN '1' THEN 'GHA'
    WHEN '2' THEN 'KEN' WHEN '3' THEN 'ETH' WHEN '4' THEN 'UGA' WHEN '5' THEN 'TZA' WHEN '6' THEN 'SEN'
    ELSE country_code END LIMIT 5),
top5 AS (SELECT * FROM malaria WHERE country_code IN (SELECT country_code FROM best))
SELECT 'life_expectancy_trend' AS "view", count(DISTINCT year) AS "rows" FROM life
UNION ALL SELECT 'malaria_heatmap', count(DISTINCT country_code) FROM top5
UNION ALL SELECT 'malaria_trends_top', count(*) FROM top5 WHERE value IS NOT NULL
UNION ALL SELECT 'nigeria_physicians', count(*) FROM beds WHERE country_code = 'NATION_0'
UNION ALL SELECT 'nigeria_vs_ssa_life_expectancy', (SELECT count(*) FROM panel WHERE year BETWEEN 2000 AND 2022)
  + (SELECT count(DISTINCT year) FROM panel WHERE year BETWEEN 2000 AND 2022)""",
}
