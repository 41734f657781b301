"""Independent SQL for the retail queries, written for DuckDB."""

from __future__ import annotations

RAW = """
raw AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS InvoiceNo,
         CASE WHEN l_partkey % 97 = 0 THEN 'POST' WHEN l_partkey % 89 = 0 THEN 'B'
              ELSE lpad(CAST(l_partkey AS VARCHAR), 6, '0') END AS StockCode,
         CASE WHEN l_partkey % 97 <> 0 AND l_partkey % 89 = 0 THEN 'Adjust bad debt'
              ELSE p_name END AS Description,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS Quantity,
         CAST(floor(l_extendedprice * 100 / l_quantity) / CAST(100 AS DOUBLE) AS DECIMAL(12,2)) AS UnitPrice,
         o_orderdate AS InvoiceDate,
         CASE WHEN o_custkey % 4 <> 0 THEN o_custkey END AS CustomerID,
         l_orderkey AS line_no
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""
LINES = (
    RAW
    + """,
totalled AS (
  SELECT *, CAST(CAST(Quantity AS DECIMAL(10,0)) * UnitPrice AS DECIMAL(18,2)) AS LineTotal FROM raw
),
lines AS (
  SELECT *, InvoiceDate IS NULL OR LineTotal IS NULL AS bad_data,
         NOT is_cancellation AND NOT is_adjustment AND LineTotal IS NOT NULL AS is_operational
  FROM (
    SELECT *, upper(InvoiceNo) LIKE 'C%' AS is_cancellation, LineTotal < 0 AS negative_revenue,
           upper(StockCode) = 'B' AND (upper(Description) LIKE '%ADJUST%'
             OR upper(Description) LIKE '%BAD DEBT%') AS is_adjustment
    FROM totalled)
)"""
)
DAILY = (
    LINES
    + """,
invoices AS (
  SELECT date_trunc('day', InvoiceDate) AS date, InvoiceNo, SUM(LineTotal) AS total
  FROM lines WHERE is_operational GROUP BY 1, 2
),
daily AS (
  SELECT a.date, a.tx_all, coalesce(i.transactions, 0) AS transactions,
         coalesce(i.revenue, 0) AS operational_revenue, a.cancellations,
         coalesce(i.revenue / i.transactions, 0) AS aov
  FROM (SELECT date_trunc('day', InvoiceDate) AS date, COUNT(*) AS tx_all,
               COUNT(*) FILTER (WHERE is_cancellation) AS cancellations
        FROM lines GROUP BY 1) a
  LEFT JOIN (SELECT date, COUNT(*) AS transactions, CAST(SUM(total) AS DOUBLE) AS revenue
             FROM invoices GROUP BY 1) i ON a.date = i.date
)"""
)
OPERATIONS = (
    LINES
    + """,
operations AS (
  SELECT date_trunc('day', InvoiceDate) AS date, CAST(SUM(LineTotal) AS DOUBLE) AS daily_revenue,
         COUNT(DISTINCT InvoiceNo) AS daily_orders, SUM(Quantity) AS daily_items,
         COUNT(DISTINCT CustomerID) AS active_customers
  FROM lines WHERE NOT is_cancellation AND NOT is_adjustment GROUP BY 1
)"""
)
ACTIVITY = (
    LINES
    + """,
activity AS (
  SELECT date_trunc('day', InvoiceDate) AS date, COUNT(*) AS tx_all,
         COUNT(*) FILTER (WHERE NOT is_cancellation AND NOT is_adjustment) AS tx_operational,
         coalesce(CAST(SUM(LineTotal) FILTER (WHERE NOT is_cancellation AND NOT is_adjustment) AS DOUBLE), 0)
           AS operational_revenue
  FROM lines GROUP BY 1
)"""
)
PRODUCTS = (
    LINES
    + """,
sold AS (SELECT * FROM lines WHERE is_operational),
described AS (
  SELECT StockCode, Description FROM sold WHERE Description IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY StockCode ORDER BY line_no, Description) = 1
),
grand AS (SELECT CAST(SUM(LineTotal) AS DOUBLE) AS revenue, SUM(Quantity) AS qty FROM sold),
products AS (
  SELECT p.StockCode, p.revenue, p.qty, p.tx_lines, p.distinct_customers, p.n_orders,
         coalesce(d.Description, '') AS description,
         CASE WHEN length(coalesce(d.Description, '')) > 60
              THEN substring(d.Description, 1, 57) || '...' ELSE coalesce(d.Description, '') END AS desc_short,
         CASE WHEN p.qty <> 0 THEN p.revenue / p.qty END AS avg_price,
         p.revenue / grand.revenue AS rev_share, p.qty / grand.qty AS qty_share,
         length(p.StockCode) <= 3 OR regexp_full_match(p.StockCode, '[A-Z]+') AS is_meta
  FROM (SELECT StockCode, CAST(SUM(LineTotal) AS DOUBLE) AS revenue, SUM(Quantity) AS qty,
               COUNT(InvoiceNo) AS tx_lines, COUNT(DISTINCT CustomerID) AS distinct_customers,
               COUNT(DISTINCT InvoiceNo) AS n_orders
        FROM sold GROUP BY 1) p
  LEFT JOIN described d ON p.StockCode = d.StockCode, grand
)"""
)


def _scores(base: str, figures: str) -> str:
    """Quartile ranks by closed form over row numbers; base gives the lines, figures the customers."""
    return (
        base
        + ",\n"
        + figures
        + """,
ranked AS (
  SELECT *, COUNT(*) OVER () AS n,
         row_number() OVER (ORDER BY recency_days, CustomerID) AS r,
         row_number() OVER (ORDER BY frequency, CustomerID) AS f,
         row_number() OVER (ORDER BY monetary, CustomerID) AS m
  FROM customers
),
scored AS (
  SELECT CustomerID, last_tx, recency_days, frequency, monetary, R_rank, F_rank, M_rank,
         R_rank * 100 + F_rank * 10 + M_rank AS RFM_score
  FROM (
    SELECT *, CAST(5 - greatest(1, (4 * (r - 1) + n - 2) // (n - 1)) AS INTEGER) AS R_rank,
           CAST(greatest(1, (4 * (f - 1) + n - 2) // (n - 1)) AS INTEGER) AS F_rank,
           CAST(greatest(1, (4 * (m - 1) + n - 2) // (n - 1)) AS INTEGER) AS M_rank
    FROM ranked)
)"""
    )


RFM = _scores(
    LINES,
    """
base AS (SELECT * FROM lines WHERE NOT is_cancellation AND NOT is_adjustment),
customers AS (
  SELECT CustomerID, max(InvoiceDate) AS last_tx,
         CAST(floor(date_diff('second', max(InvoiceDate),
           (SELECT max(InvoiceDate) FROM base) + INTERVAL 1 DAY) / 86400) AS DOUBLE) AS recency_days,
         COUNT(DISTINCT InvoiceNo) AS frequency, CAST(SUM(LineTotal) AS DOUBLE) AS monetary
  FROM base WHERE CustomerID IS NOT NULL GROUP BY 1
)""",
)
SEGMENTS = (
    _scores(
        LINES,
        """
base AS (SELECT * FROM lines WHERE NOT is_cancellation
         AND NOT (length(StockCode) <= 3 OR regexp_full_match(StockCode, '[A-Z]+'))),
customers AS (
  SELECT CustomerID, max(InvoiceDate) AS last_tx,
         CAST(greatest(0, date_diff('day', date_trunc('day', max(InvoiceDate)),
           (SELECT date_trunc('day', max(InvoiceDate) + INTERVAL 1 DAY) FROM base))) AS INTEGER) AS recency_days,
         CAST(COUNT(DISTINCT InvoiceNo) AS INTEGER) AS frequency, CAST(SUM(LineTotal) AS DOUBLE) AS monetary
  FROM base WHERE CustomerID IS NOT NULL GROUP BY 1
)""",
    )
    + """,
labelled AS (
  SELECT *, CASE WHEN RFM_score = 444 THEN 'Champion'
                 WHEN least(R_rank, F_rank, M_rank) >= 3 THEN 'Loyal'
                 WHEN R_rank <= 2 AND F_rank >= 3 THEN 'At Risk'
                 WHEN R_rank = 1 AND F_rank = 1 THEN 'Lost' ELSE 'Other' END AS segment
  FROM scored
)"""
)


def _spikes(score: str, test: str, limit: str, only: bool = True) -> str:
    return f"""WITH {LINES},
daily AS (
  SELECT date_trunc('day', InvoiceDate) AS date, COUNT(*) AS transactions,
         coalesce(CAST(SUM(LineTotal) AS DOUBLE), 0) AS operational_revenue
  FROM lines WHERE NOT is_cancellation GROUP BY 1
),
stats AS (SELECT {limit} FROM daily)
SELECT date, transactions, {'operational_revenue,' if only else ''}
       round({score}, 6) AS spike_score, {test} AS is_spike
FROM daily, stats {'WHERE ' + test if only else ''}"""


_OVER = "(transactions - cap) / (cap + 1e-9)"
_DESCRIBE = """SELECT '{c}' AS "column", COUNT({c}) AS count, round(avg(CAST({c} AS DOUBLE)), {d}) AS mean,
  round(stddev_samp(CAST({c} AS DOUBLE)), {d}) AS std, CAST(min({c}) AS DOUBLE) AS min,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), {d}) AS q25,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), {d}) AS q50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), {d}) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {t}"""


def _describe(base: str, source: str, columns: list[str], digits: int) -> str:
    parts = [_DESCRIBE.format(c=c, t=source, d=digits) for c in columns]
    return f"WITH {base}\n" + "\nUNION ALL ".join(parts)


_PRODUCT_COLUMNS = """StockCode, revenue, qty, CAST(tx_lines AS BIGINT) AS tx_lines, distinct_customers,
  description, desc_short, avg_price, rev_share, qty_share, is_meta"""

ORACLE = {
    "word_cut_names": """WITH t AS (
  SELECT p_partkey, p_name || ' ' || p_type || ' ' || p_brand || ' ' || p_name || ' ' || p_type || ' end' AS text FROM part)
SELECT p_partkey, CASE WHEN length(text) <= 60 THEN text
  ELSE regexp_replace(substr(text, 1, 58), ' [^ ]*$', '') || '...' END AS desc_short FROM t""",
    "retail_job_daily": f"""WITH {DAILY}
SELECT date, tx_all, transactions, round(operational_revenue, 2) AS operational_revenue, cancellations FROM daily""",
    "daily_kpis": f"WITH {DAILY} SELECT * FROM daily ORDER BY date",
    "daily_kpis_partition_labels": f"""WITH {DAILY}
SELECT date, tx_all, strftime(date, '%Y') AS year_str, strftime(date, '%m') AS month_str FROM daily""",
    "line_flags": f"""WITH {LINES}
SELECT is_cancellation, is_adjustment, is_operational, negative_revenue, bad_data,
       COUNT(*) AS lines, CAST(SUM(LineTotal) AS DOUBLE) AS total
FROM lines GROUP BY 1, 2, 3, 4, 5""",
    "debt_adjustments": f"""WITH {LINES}
SELECT StockCode, COUNT(*) AS lines, CAST(SUM(LineTotal) AS DOUBLE) AS total FROM lines
WHERE StockCode = 'B' AND Description ILIKE '%adjust bad debt%' AND LineTotal < 0 GROUP BY 1""",
    "review_sample": f"""WITH {LINES}
SELECT InvoiceDate, InvoiceNo, CustomerID, StockCode, Description, Quantity,
       CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(LineTotal AS DOUBLE) AS LineTotal,
       is_cancellation, is_adjustment, is_operational
FROM lines WHERE LineTotal IS NOT NULL
ORDER BY InvoiceDate DESC NULLS LAST, InvoiceNo NULLS LAST, CustomerID NULLS LAST, StockCode NULLS LAST,
         Description NULLS LAST, Quantity, UnitPrice, LineTotal LIMIT 500""",
    "daily_operations": f"WITH {OPERATIONS} SELECT * FROM operations ORDER BY date",
    "moving_average_7": f"""WITH {OPERATIONS}
SELECT date, daily_revenue,
       round(avg(daily_revenue) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS revenue_ma7
FROM operations""",
    "weekly_revenue": f"""WITH {LINES},
weekly AS (
  SELECT date_trunc('week', InvoiceDate) + INTERVAL 6 DAY AS week, SUM(LineTotal) AS total
  FROM lines WHERE NOT is_cancellation AND NOT is_adjustment GROUP BY 1
),
weeks AS (SELECT unnest(generate_series((SELECT min(week) FROM weekly), (SELECT max(week) FROM weekly),
                                        INTERVAL 7 DAY)) AS week)
SELECT CAST(weeks.week AS TIMESTAMP) AS week, coalesce(CAST(total AS DOUBLE), 0) AS weekly_revenue
FROM weeks LEFT JOIN weekly ON weeks.week = weekly.week""",
    "kpi_trend": f"WITH {DAILY} SELECT date, operational_revenue, transactions FROM daily",
    "kpi_headline": f"""WITH {DAILY}
SELECT round(SUM(operational_revenue), 4) AS total_revenue, CAST(SUM(transactions) AS BIGINT) AS total_transactions,
       round(avg(aov), 4) AS mean_aov, COUNT(*) FILTER (WHERE cancellations > 0) AS days_with_cancellations
FROM daily""",
    "kpi_headline_in_range": f"""WITH {DAILY}
SELECT round(SUM(operational_revenue), 4) AS total_revenue, CAST(SUM(transactions) AS BIGINT) AS total_transactions,
       round(avg(aov), 4) AS mean_aov, COUNT(*) FILTER (WHERE cancellations > 0) AS days_with_cancellations
FROM daily WHERE date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""",
    "cancellation_rate": f"""WITH {LINES}
SELECT COUNT(*) FILTER (WHERE is_cancellation) AS cancelled_lines,
       COUNT(*) FILTER (WHERE is_cancellation) / COUNT(*) AS cancellation_rate,
       COUNT(DISTINCT CustomerID) AS total_customers FROM lines""",
    "missing_dates": f"""WITH {DAILY},
days AS (SELECT unnest(generate_series((SELECT min(date) FROM daily), (SELECT max(date) FROM daily),
                                       INTERVAL 1 DAY)) AS date)
SELECT CAST(date AS TIMESTAMP) AS date FROM days WHERE date NOT IN (SELECT date FROM daily)""",
    "low_activity_days": f"WITH {ACTIVITY} SELECT * FROM activity WHERE tx_operational <= 1",
    "busiest_days": f"WITH {ACTIVITY} SELECT * FROM activity ORDER BY tx_operational DESC, date LIMIT 5",
    "daily_activity": f"WITH {ACTIVITY} SELECT * FROM activity",
    "bad_days": f"""WITH {LINES}
SELECT date_trunc('day', InvoiceDate) AS date,
       COUNT(*) FILTER (WHERE CustomerID IS NULL) / COUNT(*) AS bad_frac
FROM lines GROUP BY 1 HAVING COUNT(*) FILTER (WHERE CustomerID IS NULL) / COUNT(*) > 0.5""",
    "activity_histogram": f"""WITH {ACTIVITY},
span AS (SELECT min(tx_operational) AS lo, (max(tx_operational) - min(tx_operational)) / 60 AS w FROM activity),
slots AS (SELECT unnest(range(60)) AS bin),
placed AS (SELECT least(CAST(floor((tx_operational - lo) / w) AS BIGINT), 59) AS bin FROM activity, span)
SELECT CAST(slots.bin AS INTEGER) AS bin, round(any_value(lo) + slots.bin * any_value(w), 6) AS bin_start,
       COUNT(placed.bin) AS n
FROM slots CROSS JOIN span LEFT JOIN placed ON slots.bin = placed.bin GROUP BY slots.bin""",
    "daily_describe": _describe(ACTIVITY, "activity", ["tx_all", "tx_operational"], 4),
    "spikes_iqr": _spikes(
        _OVER, "transactions > cap",
        "quantile_cont(transactions, 0.75) + 1.5 * (quantile_cont(transactions, 0.75) - quantile_cont(transactions, 0.25)) AS cap",
    ),
    "spikes_zscore": _spikes(
        "coalesce((transactions - mean) / nullif(sd, 0), 0)",
        "coalesce((transactions - mean) / nullif(sd, 0), 0) > 2.0",
        "avg(transactions) AS mean, stddev_pop(transactions) AS sd",
    ),
    "spikes_percentile": _spikes(
        _OVER, "transactions > cap", "quantile_cont(transactions, 0.98) AS cap"
    ),
    "spike_flags": _spikes(
        _OVER, "transactions > cap", "quantile_cont(transactions, 0.95) AS cap", only=False
    ),
    "product_summary": f"WITH {PRODUCTS} SELECT {_PRODUCT_COLUMNS} FROM products",
    "product_orders": f"""WITH {PRODUCTS}
SELECT {_PRODUCT_COLUMNS.replace("desc_short, ", "")}, n_orders FROM products""",
    "top_products_by_revenue": f"""WITH {PRODUCTS} SELECT {_PRODUCT_COLUMNS} FROM products
WHERE NOT is_meta ORDER BY products.revenue DESC, StockCode LIMIT 10""",
    "top_products_by_qty": f"""WITH {PRODUCTS} SELECT {_PRODUCT_COLUMNS} FROM products
ORDER BY products.qty DESC, StockCode LIMIT 10""",
    "real_products": f"WITH {PRODUCTS} SELECT StockCode, revenue, qty, is_meta FROM products WHERE NOT is_meta",
    "pareto_top100": f"""WITH {PRODUCTS},
best AS (SELECT StockCode, revenue FROM products WHERE NOT is_meta ORDER BY revenue DESC, StockCode LIMIT 100)
SELECT StockCode, revenue, round(SUM(revenue) OVER w, 2) AS cum_rev,
       round(SUM(revenue) OVER w / (SELECT SUM(revenue) FROM best), 8) AS cum_share
FROM best WINDOW w AS (ORDER BY revenue DESC, StockCode ROWS UNBOUNDED PRECEDING)""",
    "short_descriptions": """SELECT doc_id, CASE WHEN length(text) > 60 THEN substring(text, 1, 57) || '...'
  ELSE text END AS desc_short FROM documents""",
    "gross_net_revenue": f"""WITH {LINES}
SELECT CAST(SUM(LineTotal) AS DOUBLE) AS gross_revenue,
       CAST(SUM(CASE WHEN NOT is_cancellation THEN LineTotal END) AS DOUBLE) AS net_revenue,
       COUNT(*) FILTER (WHERE is_cancellation) AS cancel_rows,
       COUNT(*) FILTER (WHERE is_cancellation) / COUNT(*) AS cancel_share,
       COUNT(*) FILTER (WHERE negative_revenue) AS negative_rows,
       COUNT(*) FILTER (WHERE negative_revenue) / COUNT(*) AS negative_share
FROM lines""",
    "invoice_reconciliation": f"""WITH {LINES}
SELECT InvoiceNo, COUNT(LineTotal) AS lines, CAST(SUM(LineTotal) AS DOUBLE) AS sum_line,
       COUNT(*) FILTER (WHERE LineTotal > 0) AS pos_lines, COUNT(*) FILTER (WHERE LineTotal < 0) AS neg_lines,
       bool_or(is_cancellation) AS is_cancel_any FROM lines GROUP BY 1""",
    "suspect_invoices_top10": f"""WITH {LINES}
SELECT InvoiceNo, COUNT(LineTotal) AS lines, CAST(SUM(LineTotal) AS DOUBLE) AS sum_line,
       COUNT(*) FILTER (WHERE LineTotal > 0) AS pos_lines, COUNT(*) FILTER (WHERE LineTotal < 0) AS neg_lines,
       bool_or(is_cancellation) AS is_cancel_any
FROM lines GROUP BY 1 HAVING COUNT(*) FILTER (WHERE LineTotal < 0) > 0 OR bool_or(is_cancellation)
ORDER BY neg_lines DESC, InvoiceNo LIMIT 10""",
    "negative_lines": f"""WITH {LINES}
SELECT COUNT(*) AS negative_rows, COUNT(*) FILTER (WHERE is_cancellation) AS cancelled,
       COUNT(*) FILTER (WHERE is_adjustment) AS adjusted,
       COUNT(*) FILTER (WHERE NOT is_cancellation) AS outside_cancellations,
       COUNT(*) FILTER (WHERE NOT is_cancellation AND NOT is_adjustment) AS residual
FROM lines WHERE LineTotal < 0""",
    "null_profile": f"""WITH {LINES}, counted AS (SELECT COUNT(*) AS n FROM lines)
{" UNION ALL ".join(
    f'''SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS nulls, (COUNT(*) - COUNT({c})) / COUNT(*) * 100 AS pct_null FROM lines'''
    for c in ("InvoiceNo", "StockCode", "Description", "Quantity", "UnitPrice", "InvoiceDate",
              "CustomerID", "line_no", "LineTotal"))}""",
    "identifier_counts": f"""WITH {LINES}
SELECT 'InvoiceNo' AS "column", COUNT(DISTINCT InvoiceNo) AS n_distinct FROM lines
UNION ALL SELECT 'StockCode', COUNT(DISTINCT StockCode) FROM lines
UNION ALL SELECT 'CustomerID', COUNT(DISTINCT CustomerID) FROM lines""",
    "customer_missing_share": f"""WITH {LINES}
SELECT COUNT(CustomerID) AS non_null, COUNT(*) - COUNT(CustomerID) AS missing,
       (COUNT(*) - COUNT(CustomerID)) / COUNT(*) AS missing_share FROM lines""",
    "missing_customer_rows": f"""WITH {LINES}
SELECT InvoiceNo, StockCode, Quantity FROM lines WHERE CustomerID IS NULL
ORDER BY InvoiceNo, StockCode, Quantity LIMIT 8""",
    "date_parse_check": """WITH t AS (SELECT strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS d FROM orders)
SELECT 'month_first' AS format, COUNT(*) - COUNT(try_strptime(d, '%m/%d/%Y %H:%M')) AS failures,
       (COUNT(*) - COUNT(try_strptime(d, '%m/%d/%Y %H:%M'))) / COUNT(*) AS failure_share FROM t
UNION ALL
SELECT 'day_first', COUNT(*) - COUNT(try_strptime(d, '%d/%m/%Y %H:%M')),
       (COUNT(*) - COUNT(try_strptime(d, '%d/%m/%Y %H:%M'))) / COUNT(*) FROM t""",
    "parsed_invoice_dates": """SELECT o_orderdate AS InvoiceDate, COUNT(*) AS rows,
       COUNT(*) FILTER (WHERE day(o_orderdate) > 12) AS day_first_failures FROM orders GROUP BY 1""",
    "rfm_scores": f"WITH {RFM} SELECT * FROM scored",
    "rfm_segments": f"WITH {SEGMENTS} SELECT * FROM labelled",
    "rfm_segment_counts": f"WITH {RFM} SELECT RFM_score, COUNT(*) AS customers FROM scored GROUP BY 1",
    "top_customers": f"""WITH {RFM} SELECT CustomerID, monetary, frequency, recency_days FROM scored
ORDER BY monetary DESC, CustomerID LIMIT 20""",
    "rfm_clipped": f"""WITH {SEGMENTS},
caps AS (SELECT quantile_cont(CAST(frequency AS DOUBLE), 0.99) AS f, quantile_cont(monetary, 0.99) AS m FROM scored)
SELECT CustomerID, CAST(least(recency_days, 365) AS DOUBLE) AS recency_clip,
       round(least(CAST(frequency AS DOUBLE), f), 4) AS frequency_clip,
       round(least(monetary, m), 4) AS monetary_clip FROM scored, caps""",
    "rfm_describe": _describe(RFM, "scored", ["recency_days", "frequency", "monetary"], 3),
    "rfm_histograms": f"""WITH {SEGMENTS},
caps AS (SELECT quantile_cont(CAST(frequency AS DOUBLE), 0.99) AS f, quantile_cont(monetary, 0.99) AS m FROM scored),
clipped AS (
  SELECT 'recency' AS metric, CAST(least(recency_days, 365) AS DOUBLE) AS v FROM scored
  UNION ALL SELECT 'frequency', least(CAST(frequency AS DOUBLE), f) FROM scored, caps
  UNION ALL SELECT 'monetary', least(monetary, m) FROM scored, caps),
span AS (SELECT metric, min(v) AS lo, max(v) AS hi FROM clipped GROUP BY 1),
placed AS (
  SELECT metric, CAST(least(floor((v - start) / width), 29) AS INTEGER) AS bin
  FROM clipped JOIN (SELECT metric, CASE WHEN hi > lo THEN lo ELSE lo - 0.5 END AS start,
                            CASE WHEN hi > lo THEN (hi - lo) / 30 ELSE 1.0 / 30 END AS width FROM span) USING (metric))
SELECT metric, CAST(b.bin AS INTEGER) AS bin, COUNT(placed.bin) AS n
FROM span CROSS JOIN (SELECT unnest(range(30)) AS bin) b LEFT JOIN placed USING (metric, bin)
GROUP BY metric, b.bin""",
    "operational_sample": f"""WITH {LINES}
SELECT InvoiceNo, StockCode, InvoiceDate, Quantity, bad_data FROM lines WHERE NOT bad_data
ORDER BY InvoiceDate DESC NULLS LAST, InvoiceNo NULLS LAST, CustomerID NULLS LAST, StockCode NULLS LAST,
         Description NULLS LAST, Quantity, UnitPrice, LineTotal LIMIT 500""",
}
