"""Independent SQL for the file, document and stream queries, written for DuckDB."""

from __future__ import annotations

from almanac.plans.derived import DOCUMENT_ORDERS, LINE_FILE_ORDERS
from almanac.plans.health_oracle import TITLES

PEOPLE = """people AS (
  SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END AS id,
         CASE WHEN c_custkey % 15 <> 0 THEN c_name END AS name,
         CASE WHEN c_custkey % 13 = 0 THEN 'twenty' WHEN c_custkey % 17 = 0 THEN '150'
              WHEN c_custkey % 19 = 0 THEN '-5' WHEN c_custkey % 29 = 0 THEN NULL
              ELSE CAST(c_nationkey + 20 AS VARCHAR) END AS age,
         'user' || c_custkey || '@example.com' AS email,
         CASE WHEN c_custkey % 21 = 0 THEN '2021-99-99' WHEN c_custkey % 22 = 0 THEN '06/20/2021'
              WHEN c_custkey % 23 = 0 THEN NULL ELSE '2020-01-02' END AS signup_date
  FROM customer),
issues AS (
  SELECT c_custkey AS row_id, 1 AS nr, 'id' AS "column", 'missing' AS issue, NULL AS expected, NULL AS value
  FROM people WHERE id IS NULL
  UNION ALL SELECT c_custkey, 2, 'name', 'missing', NULL, NULL FROM people WHERE name IS NULL
  UNION ALL SELECT c_custkey, 3, 'age', 'missing', NULL, NULL FROM people WHERE age IS NULL
  UNION ALL SELECT c_custkey, 4, 'age', 'type_mismatch', 'int', age FROM people WHERE age = 'twenty'
  UNION ALL SELECT c_custkey, 5, 'age', 'out_of_range', NULL, age FROM people
    WHERE try_cast(age AS INTEGER) NOT BETWEEN 0 AND 120
  UNION ALL SELECT c_custkey, 6, 'signup_date', 'invalid_date', NULL, signup_date FROM people
    WHERE signup_date = '2021-99-99')"""
_PLACE = """CAST(row_number() OVER (PARTITION BY row_id ORDER BY nr) - 1 AS INTEGER) AS place"""
CODED = """coded AS (
  SELECT o_orderkey, o_orderpriority, o_orderstatus, o_orderdate, o_totalprice,
         'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code, CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
CLEAN = f"""{CODED},
landed AS (SELECT *, o_orderkey // {DOCUMENT_ORDERS} AS chunk FROM coded),
newest AS (SELECT * FROM landed QUALIFY chunk = max(chunk) OVER (PARTITION BY year))"""
SHEETS = f"""{PEOPLE},
found AS (
  SELECT 'people' AS folder, "column", issue, value FROM issues
  UNION ALL SELECT 'suppliers', 'name', 'missing', NULL FROM supplier
  UNION ALL SELECT 'parts', 'age', 'out_of_range', CAST(p_size * 4 AS VARCHAR) FROM part WHERE p_size * 4 > 120)"""
WARDS = """patient AS (
  SELECT user_id || '-' || strftime(ts, '%Y-%m-%d') AS visit_id, 'ward-' || (user_id % 8) AS ward, ts,
         CASE WHEN event_type IN ('view', 'signup') THEN 'arrive' WHEN event_type = 'click' THEN 'admit'
              ELSE 'discharge' END AS kind FROM events),
waits AS (
  SELECT visit_id, ward, CAST(floor(epoch(admitted - arrived)) AS BIGINT) AS wait_seconds
  FROM (SELECT visit_id, ward, min(ts) FILTER (WHERE kind = 'arrive') AS arrived,
               min(ts) FILTER (WHERE kind = 'admit') AS admitted FROM patient GROUP BY 1, 2)
  WHERE admitted >= arrived)"""
REPORTS = """reports AS (
  SELECT user_id AS num_rows, CASE WHEN event_type = 'error' THEN user_id % 5 ELSE 0 END AS total_issues,
         user_id % 50 = 0 AS lacks, ts FROM events)"""


def _profile(column: str, kind: str) -> str:
    return f"""SELECT '{column}' AS "column", COUNT({column}) AS non_null_count,
  COUNT(DISTINCT {column}) AS "unique", '{kind}' AS dtype FROM people"""


_HEX = "sha256(o_orderpriority || o_orderkey)[1:32]"

ORACLE = {
    "row_issues": f"""WITH {PEOPLE} SELECT row_id, {_PLACE}, "column", issue, expected, value FROM issues""",
    "typed_row_issues": f"""WITH issues AS (
  SELECT c_custkey AS row_id, 1 AS nr, 'c_acctbal' AS "column", 'out_of_range' AS issue,
         CAST(CAST(trunc(c_acctbal) AS BIGINT) AS VARCHAR) AS value
  FROM customer WHERE trunc(c_acctbal) < 0 OR trunc(c_acctbal) > 9000
  UNION ALL SELECT c_custkey, 2, 'c_phone', 'missing', NULL FROM customer)
SELECT row_id, {_PLACE}, "column", issue, CAST(NULL AS VARCHAR) AS expected, value FROM issues""",
    "total_issues": f"""WITH {PEOPLE} SELECT (SELECT COUNT(*) FROM people) AS num_rows,
  COUNT(DISTINCT row_id) AS rows_with_issues, COUNT(*) AS total_issues FROM issues""",
    "issue_counts": f"""WITH {PEOPLE} SELECT "column", issue, COUNT(*) AS n FROM issues GROUP BY 1, 2""",
    "unique_key_issues": """SELECT 'l_orderkey' AS "column", 'duplicate' AS issue, COUNT(*) AS n FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1)""",
    "prototype_issues": f"""WITH {PEOPLE}, early AS (
  SELECT c_custkey AS row_id, 1 AS nr, 'id' AS "column", 'missing_required' AS issue, NULL AS value
  FROM people WHERE id IS NULL
  UNION ALL SELECT c_custkey, 2, 'name', 'missing_required', NULL FROM people WHERE name IS NULL
  UNION ALL SELECT c_custkey, 3, 'age', 'missing_required', NULL FROM people WHERE age IS NULL
  UNION ALL SELECT c_custkey, 4, 'age', 'not_integer', age FROM people WHERE age IS NULL OR age = 'twenty'
  UNION ALL SELECT c_custkey, 5, 'age', 'age_out_of_range', age FROM people
    WHERE try_cast(age AS INTEGER) NOT BETWEEN 0 AND 120)
SELECT row_id AS c_custkey, {_PLACE}, "column", issue, value FROM early""",
    "column_profile": f"""WITH {PEOPLE} {" UNION ALL ".join([
        _profile("c_custkey", "int64"), _profile("id", "float64"), _profile("name", "object"),
        _profile("age", "object"), _profile("email", "object"), _profile("signup_date", "object")])}""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2
HAVING COUNT(*) > 1""",
    "file_reports": f"""WITH {SHEETS}
SELECT s.folder, s.num_rows, s.num_columns, s.columns_present, s.missing_required_columns,
       (SELECT COUNT(*) FROM found f WHERE f.folder = s.folder) AS total_issues
FROM (SELECT 'people' AS folder, COUNT(*) AS num_rows, CAST(5 AS INTEGER) AS num_columns,
             'id,name,age,email,signup_date' AS columns_present, '' AS missing_required_columns FROM customer
      UNION ALL SELECT 'suppliers', COUNT(*), 3, 'id,age,s_name', 'name' FROM supplier
      UNION ALL SELECT 'parts', COUNT(*), 5, 'name,id,age,email,price', '' FROM part) s""",
    "file_issue_counts": f"""WITH {SHEETS} SELECT folder, "column", issue, value, COUNT(*) AS n FROM found
GROUP BY 1, 2, 3, 4""",
    "file_column_types": f"""WITH {PEOPLE}
SELECT 'people' AS folder, 'id' AS name, 'float64' AS dtype, COUNT(id) AS non_null FROM people
UNION ALL SELECT 'people', 'name', 'object', COUNT(name) FROM people
UNION ALL SELECT 'people', 'age', 'object', COUNT(age) FROM people
UNION ALL SELECT 'people', 'email', 'object', COUNT(email) FROM people
UNION ALL SELECT 'people', 'signup_date', 'object', COUNT(signup_date) FROM people
UNION ALL SELECT 'suppliers', 'id', 'float64', COUNT(*) FROM supplier
UNION ALL SELECT 'suppliers', 'age', 'int64', COUNT(*) FROM supplier
UNION ALL SELECT 'suppliers', 's_name', 'object', COUNT(*) FROM supplier
UNION ALL SELECT 'parts', 'name', 'object', COUNT(*) FROM part
UNION ALL SELECT 'parts', 'id', 'int64', COUNT(*) FROM part
UNION ALL SELECT 'parts', 'age', 'int64', COUNT(*) FROM part
UNION ALL SELECT 'parts', 'email', 'float64', CAST(0 AS BIGINT)
UNION ALL SELECT 'parts', 'price', 'float64', COUNT(*) FROM part""",
    "file_qc_stream": f"""WITH {SHEETS}, counts AS (
  SELECT 'people' AS folder, COUNT(*) AS num_rows FROM customer
  UNION ALL SELECT 'suppliers', COUNT(*) FROM supplier UNION ALL SELECT 'parts', COUNT(*) FROM part)
SELECT folder, num_rows, (SELECT COUNT(*) FROM found f WHERE f.folder = counts.folder) AS total_issues FROM counts""",
    "file_report_documents": f"""WITH {SHEETS} SELECT folder, COUNT(*) AS total_issues FROM found GROUP BY 1""",
    "report_issue_lines": f"""WITH {SHEETS} SELECT folder, "column", issue, value, COUNT(*) AS n FROM found
GROUP BY 1, 2, 3, 4""",
    "report_keys": """SELECT unnest(['people', 'suppliers', 'parts']) AS folder, true AS shaped""",
    "report_objects": f"""WITH {SHEETS}, sheets AS (
  SELECT 'people' AS folder, count(*) AS n FROM customer UNION ALL SELECT 'suppliers', count(*) FROM supplier
  UNION ALL SELECT 'parts', count(*) FROM part),
missing AS (SELECT folder, count(*) AS n FROM found GROUP BY folder)
SELECT sheets.folder, true AS one_object_each, sheets.n AS num_rows, coalesce(missing.n, 0) AS total_issues,
       coalesce(missing.n, 0) AS listed_issues FROM sheets LEFT JOIN missing ON sheets.folder = missing.folder""",
    "file_checks_multiline": f"""WITH {PEOPLE} SELECT 'notes' AS folder, (SELECT count(*) FROM people) AS num_rows,
  CAST(6 AS BIGINT) AS num_columns, 'id|name|age|email|signup_date|remark,' || chr(10) || 'free text' AS columns_present,
  count(*) AS total_issues FROM issues""",
    "landed_rows": """SELECT s_name, true AS from_file, TIMESTAMP '2024-05-06 07:08:09' AS ingested_at FROM supplier""",
    "raw_file_hashes": f"""SELECT l_orderkey // {LINE_FILE_ORDERS} AS part,
  sha256(string_agg(line || chr(10), '' ORDER BY l_orderkey, l_linenumber, line)) AS sha256 FROM (
  SELECT l_orderkey, l_linenumber, l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|'
         || rpad(l_returnflag, 150, 'l_') AS line FROM lineitem) GROUP BY part""",
    "report_verdicts": f"""WITH {REPORTS} SELECT CASE WHEN total_issues = 0 AND NOT lacks THEN 'pass' ELSE 'fail' END AS status,
       COUNT(*) AS files FROM reports GROUP BY 1""",
    "quality_trend": f"""WITH {REPORTS} SELECT date_trunc('day', ts) AS day, COUNT(*) AS files,
       CAST(SUM(num_rows) AS BIGINT) AS rows, CAST(SUM(total_issues) AS BIGINT) AS issues FROM reports GROUP BY 1""",
    "gho_rows": f"""WITH {CODED}
SELECT o_orderkey, code AS country_code, year, CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS value,
       o_orderpriority AS indicator_code FROM coded WHERE o_orderkey % 11 <> 0""",
    "world_bank_rows": f"""WITH {CODED}
SELECT o_orderkey, code AS country_code, year, CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS value,
       o_orderpriority AS indicator_id FROM coded
WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 12 <> 0""",
    "world_bank_labelled": f"""WITH {CODED}
SELECT o_orderkey, code AS country_code, lower(code) AS country_name, year, o_totalprice AS value,
       o_orderpriority AS indicator_id, o_orderstatus AS indicator_label FROM coded
WHERE o_orderkey % 11 <> 0 AND o_orderkey % 12 <> 0 AND o_orderkey % 13 <> 0""",
    "unreadable_years": f"""WITH {CODED} SELECT o_orderkey, '199x' AS date FROM coded
WHERE o_orderkey % 12 = 0 AND o_orderkey % 11 <> 0""",
    "clean_zone_quarantine": f"""WITH {CODED} SELECT o_orderkey, '199x' AS date FROM coded
WHERE o_orderkey % 12 = 0 AND o_orderkey % 11 <> 0""",
    "outbreak_rows": f"""WITH {TITLES}
SELECT t.o_orderkey, CASE WHEN t.o_orderkey % 5 <> 0 THEN 'id-' ELSE 'don-' END || t.o_orderkey AS outbreak_id,
       trim(title) AS title, 'order ' || t.o_orderkey || ' & more now' AS summary, CAST(NULL AS VARCHAR) AS overview,
       CASE WHEN shape IN (0, 1) THEN 'Cholera' WHEN shape IN (2, 3) THEN 'Measles' WHEN shape = 4 THEN 'Ebola'
            WHEN shape = 5 THEN trim(string_split(title, '-')[1]) END AS disease,
       CASE WHEN shape IN (0, 1, 2, 4) THEN n_name WHEN shape = 3 THEN place END AS country,
       CASE WHEN shape IN (0, 1, 2, 4) THEN 'n' || n_nationkey WHEN shape = 3 THEN 'r' || r_regionkey END AS country_iso2,
       CASE WHEN shape IN (0, 1, 2, 4) THEN 'nn' || n_nationkey WHEN shape = 3 THEN 'rr' || r_regionkey END AS country_iso3,
       o.o_orderdate AS publication_date, '/' || t.o_orderkey AS source_url,
       CAST(year(o.o_orderdate) AS INTEGER) AS year
FROM titles t JOIN orders o ON t.o_orderkey = o.o_orderkey WHERE t.o_orderkey % 9 <> 0""",
    "notice_export": f"""WITH {TITLES}
SELECT CASE WHEN t.o_orderkey % 5 <> 0 THEN 'id-' || t.o_orderkey ELSE
         sha256('{{"Title":' || to_json(title) || ',"Summary":' || to_json('<p>order ' || t.o_orderkey || ' &amp; more</p><b>now</b>')
           || ',"PublicationDate":' || to_json(CASE WHEN t.o_orderkey % 9 = 0 THEN 'soon' ELSE strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END) || '}}')
       END AS outbreak_id, title, '<p>order ' || t.o_orderkey || ' &amp; more</p><b>now</b>' AS summary,
       CASE WHEN t.o_orderkey % 9 = 0 THEN 'soon' ELSE strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS publication_date,
       'region-1' AS country_guid, CAST(NULL AS VARCHAR) AS disease_topic
FROM titles t JOIN orders o ON t.o_orderkey = o.o_orderkey""",
    "routed_keys": f"""WITH named AS (
  SELECT *, ['life_expectancy', 'malaria_incidence', 'cholera', 'wb_hospital_beds_per_1000',
             'wb_physicians_per_1000', 'who_outbreaks', 'other', 'cholera-life_expectancy'][o_orderkey % 8 + 1] AS name
  FROM orders)
SELECT o_orderkey, name || '/' || strftime(o_orderdate, '%Y%m%dT%H%M%SZ') || '-' || {_HEX} || '.' ||
         CASE WHEN o_orderkey % 3 = 0 THEN 'csv' ELSE 'json' END AS raw_key,
       CASE WHEN o_orderkey % 8 = 7 THEN 'life_expectancy' WHEN o_orderkey % 8 <> 6 THEN name END AS dataset,
       o_orderdate AS landed_at, {_HEX} AS landing_id FROM named""",
    "content_hashes": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "new_documents": """SELECT CAST(d.doc_id AS VARCHAR) AS raw_key, sha256(text) AS hash FROM documents d
LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR l.quality <> 1""",
    "clean_zone_stream": f"""WITH {CLEAN} SELECT code AS country_code, o_orderpriority AS indicator_code,
       o_totalprice AS value, year FROM newest""",
    "clean_zone_manifest": f"""WITH {CLEAN}
SELECT TIMESTAMP '2020-01-01' + to_seconds(chunk) AS landed_at, COUNT(*) AS rows,
       COUNT(DISTINCT year) AS written_partitions FROM landed GROUP BY chunk""",
    "clean_zone_sql": f"""WITH {CLEAN} SELECT o_orderpriority AS indicator_code, year, COUNT(*) AS n,
       max(o_totalprice) AS highest FROM newest WHERE year BETWEEN 2000 AND 2025 GROUP BY 1, 2""",
    "year_overwrite": f"""WITH {CODED} SELECT year, o_orderpriority, COUNT(*) AS n FROM coded
WHERE year <> 1998 OR o_orderpriority = '1-URGENT' GROUP BY 1, 2""",
    "two_level_partitions": f"""WITH {CODED} SELECT code AS country_code, o_totalprice AS value,
       o_orderstatus AS indicator_code, year FROM coded WHERE o_orderstatus = 'F' AND year >= 2000""",
    "daily_partition_files": """SELECT date_trunc('day', o_orderdate) AS date, COUNT(*) AS tx_all,
       CAST(year(any_value(o_orderdate)) AS INTEGER) AS year, strftime(any_value(o_orderdate), '%Y') AS year_str,
       strftime(any_value(o_orderdate), '%m') AS month_str
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "exported_result": "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1",
    "chart_ready": """SELECT event_id, value, date_trunc('day', ts) AS date FROM events WHERE event_type <> 'error'""",
    "occupancy_stream": f"""WITH {WARDS}, state AS (
  SELECT ward, COUNT(*) FILTER (WHERE kind = 'arrive') AS arrivals, COUNT(*) FILTER (WHERE kind = 'admit') AS admissions,
         COUNT(*) FILTER (WHERE kind = 'discharge') AS discharges FROM patient GROUP BY 1)
SELECT s.*, admissions - discharges AS occupancy, arrivals - admissions AS waiting, w.visits_admitted,
       w.mean_wait_seconds
FROM state s LEFT JOIN (SELECT ward, COUNT(*) AS visits_admitted, round(avg(wait_seconds), 4) AS mean_wait_seconds
                        FROM waits GROUP BY 1) w ON s.ward = w.ward""",
    "ward_waits": f"WITH {WARDS} SELECT * FROM waits",
    "ward_archive": f"WITH {WARDS} SELECT ward, kind, COUNT(*) AS n FROM patient GROUP BY 1, 2",
    "notice_dates": """SELECT o_orderkey, CASE WHEN o_orderkey % 8 < 6 THEN o_orderdate END AS publication_date,
  CASE WHEN o_orderkey % 8 = 6 THEN 'unreadable date' WHEN o_orderkey % 8 = 7 THEN 'no date' END AS reason FROM orders""",
    "undated_notice_records": """SELECT CASE WHEN o_orderkey % 8 = 6 THEN 'unreadable date' ELSE 'no date' END AS reason,
  count(*) AS records, (SELECT count(*) FROM orders WHERE o_orderkey % 8 >= 6) AS all_bad,
  (SELECT count(*) FROM orders) AS documents FROM orders WHERE o_orderkey % 8 >= 6 GROUP BY 1""",
    "ward_late_events": """WITH sent AS (
  SELECT event_id, user_id, event_type, ts,
         least(least((day(ts) - 1) // 10, 2) + CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END, 2) AS delivery FROM events),
arriving AS (SELECT * FROM sent UNION ALL SELECT * FROM sent WHERE event_id % 10 = 0),
marked AS (
  SELECT *, coalesce(ts <= (SELECT max(s.ts) FROM sent s WHERE s.delivery < a.delivery) - INTERVAL 10 MINUTE, false) AS late
  FROM arriving a),
once AS (SELECT DISTINCT event_id, 'ward-' || (user_id % 8) AS ward, event_type FROM marked WHERE NOT late),
counts AS (
  SELECT ward, count(*) FILTER (event_type IN ('view', 'signup')) AS arrivals,
         count(*) FILTER (event_type = 'click') AS admissions,
         count(*) FILTER (event_type NOT IN ('view', 'signup', 'click')) AS discharges FROM once GROUP BY ward)
SELECT *, admissions - discharges AS occupancy, arrivals - admissions AS waiting,
       (SELECT count(*) FROM marked WHERE late) AS late_events FROM counts""",
    "imaging_studies": """SELECT 'study-' || user_id AS "StudyInstanceUID", 'CL' AS "Modality",
       COUNT(DISTINCT event_id % 40) AS series, COUNT(*) AS images FROM events WHERE event_type = 'click' GROUP BY 1""",
    "churn_scores": """SELECT c_custkey, round(p, 10) AS churn_probability, p >= 0.5 AS churn FROM (
  SELECT c_custkey, 1.0 / (1.0 + exp(CAST(0.5 AS DOUBLE) + CAST(0.0002 AS DOUBLE) * c_acctbal
    - CAST(0.05 AS DOUBLE) * c_nationkey)) AS p FROM customer)""",
    "waste_report": """SELECT 'idle_instance' AS rule, COUNT(*) AS findings FROM supplier WHERE s_acctbal / 100 < 5 HAVING COUNT(*) > 0
UNION ALL SELECT 'unattached_volume', COUNT(*) FROM part WHERE p_size <= 10 HAVING COUNT(*) > 0
UNION ALL SELECT 'unused_address', COUNT(*) FROM customer WHERE c_mktsegment = 'MACHINERY' HAVING COUNT(*) > 0
UNION ALL SELECT 'old_snapshot', COUNT(*) FROM orders WHERE o_orderdate < DATE '2001-08-01' - INTERVAL 90 DAY
  HAVING COUNT(*) > 0""",
    "invoice_fields": """SELECT o_orderkey AS invoice_id, 'Vendor ' || o_custkey AS vendor, o_totalprice AS total,
       o_orderdate AS invoice_date FROM orders""",
}
