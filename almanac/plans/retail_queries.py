"""Registered queries over the retail lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from almanac.operators import profiles, retail, rfm, shape
from almanac.plans.jobs import retail_job
from almanac.plans.views import raw_retail_lines, retail_lines, table
from almanac.functions.dates import month_label, year_label
from almanac.session import checkpointed, staging_path
from almanac.sinks import tables as sink
from almanac.sources.csv import read_csv

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def daily_kpis(spark, sf_dir):
    return retail.daily_kpis(retail_lines(spark, sf_dir)).orderBy("date")


@query
def daily_kpis_partition_labels(spark, sf_dir):
    daily = retail.daily_kpis(retail_lines(spark, sf_dir))
    return daily.select(
        "date", "tx_all", year_label("date").alias("year_str"), month_label("date").alias("month_str")
    )


@query
def line_flags(spark, sf_dir):
    flags = ["is_cancellation", "is_adjustment", "is_operational", "negative_revenue", "bad_data"]
    return retail_lines(spark, sf_dir).groupBy(*flags).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("LineTotal").cast("double").alias("total")
    )


@query
def debt_adjustments(spark, sf_dir):
    lines = raw_retail_lines(spark, sf_dir).where(retail.is_debt_adjustment())
    return lines.groupBy("StockCode").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("LineTotal").cast("double").alias("total")
    )


@query
def review_sample(spark, sf_dir):
    sample = retail.review_sample(retail_lines(spark, sf_dir).drop("bad_data"))
    return sample.withColumns(
        {"UnitPrice": F.col("UnitPrice").cast("double"), "LineTotal": F.col("LineTotal").cast("double")}
    )


@query
def daily_operations(spark, sf_dir):
    return retail.daily_operations(retail_lines(spark, sf_dir)).orderBy("date")


@query
def moving_average_7(spark, sf_dir):
    daily = retail.daily_operations(retail_lines(spark, sf_dir))
    averaged = retail.moving_average(daily, "daily_revenue", "revenue_ma7")
    return averaged.select("date", "daily_revenue", F.round("revenue_ma7", 4).alias("revenue_ma7"))


@query
def weekly_revenue(spark, sf_dir):
    lines = retail_lines(spark, sf_dir).where(~F.col("is_cancellation") & ~F.col("is_adjustment"))
    return retail.weekly_totals(lines, "LineTotal", "weekly_revenue", "InvoiceDate").withColumnRenamed(
        "InvoiceDate", "week"
    )


@query
def kpi_trend(spark, sf_dir):
    daily = retail.daily_kpis(retail_lines(spark, sf_dir))
    return daily.select("date", "operational_revenue", "transactions").orderBy("date")


@query
def kpi_headline(spark, sf_dir):
    line = retail.headline(retail.daily_kpis(retail_lines(spark, sf_dir)))
    return line.withColumns(
        {c: F.round(c, 4) for c in ("total_revenue", "mean_aov")}
    )


@query
def kpi_headline_in_range(spark, sf_dir):
    daily = retail.daily_kpis(retail_lines(spark, sf_dir))
    start, end = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz")
    line = retail.headline(shape.between(daily, "date", start, end))
    return line.withColumns({c: F.round(c, 4) for c in ("total_revenue", "mean_aov")})


@query
def cancellation_rate(spark, sf_dir):
    return retail.cancellation_rate(retail_lines(spark, sf_dir))


@query
def missing_dates(spark, sf_dir):
    return retail.missing_days(retail.daily_kpis(retail_lines(spark, sf_dir)))


@query
def low_activity_days(spark, sf_dir):
    daily = retail.daily_activity(retail_lines(spark, sf_dir))
    return daily.where(F.col("tx_operational") <= 1)


@query
def busiest_days(spark, sf_dir):
    daily = retail.daily_activity(retail_lines(spark, sf_dir))
    return shape.top(daily, 5, F.col("tx_operational").desc(), F.col("date").asc())


@query
def daily_activity(spark, sf_dir):
    return retail.daily_activity(retail_lines(spark, sf_dir))


@query
def bad_days(spark, sf_dir):
    lines = retail_lines(spark, sf_dir).withColumn("bad_data", F.col("CustomerID").isNull())
    return retail.bad_share_by_day(lines, above=0.5)


@query
def activity_histogram(spark, sf_dir):
    daily = checkpointed(retail.daily_activity(retail_lines(spark, sf_dir)))
    return shape.histogram(daily, "tx_operational", 60).withColumn(
        "bin_start", F.round("bin_start", 6)
    )


@query
def daily_describe(spark, sf_dir):
    daily = checkpointed(retail.daily_activity(retail_lines(spark, sf_dir)))
    out = profiles.describe(daily, ["tx_all", "tx_operational"])
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


def _spikes(spark, sf_dir, method, **limits):
    daily = checkpointed(retail.daily_lines(retail_lines(spark, sf_dir)))
    flagged = profiles.spikes(daily, method, **limits)
    return flagged.withColumn("spike_score", F.round("spike_score", 6))


@query
def spikes_iqr(spark, sf_dir):
    return _spikes(spark, sf_dir, "iqr")


@query
def spikes_zscore(spark, sf_dir):
    return _spikes(spark, sf_dir, "zscore", z_limit=2.0)


@query
def spikes_percentile(spark, sf_dir):
    return _spikes(spark, sf_dir, "percentile", quantile=0.98)


@query
def spike_flags(spark, sf_dir):
    daily = checkpointed(retail.daily_lines(retail_lines(spark, sf_dir))).select("date", "transactions")
    return profiles.flag_spikes(daily, "percentile").withColumn(
        "spike_score", F.round("spike_score", 6)
    )


# ---- products --------------------------------------------------------------------------


def _products(spark, sf_dir, **options):
    return retail.product_summary(retail_lines(spark, sf_dir), line_order="line_no", **options)


@query
def product_summary(spark, sf_dir):
    return _products(spark, sf_dir).orderBy(F.col("revenue").desc(), "StockCode")


@query
def product_orders(spark, sf_dir):
    return _products(spark, sf_dir, with_orders=True).drop("desc_short")


@query
def top_products_by_revenue(spark, sf_dir):
    return retail.top_products(_products(spark, sf_dir), "StockCode", 10)


@query
def top_products_by_qty(spark, sf_dir):
    products = _products(spark, sf_dir)
    return retail.top_products(products, "StockCode", 10, by="qty", meta=True)


@query
def real_products(spark, sf_dir):
    products = retail.without_meta(_products(spark, sf_dir))
    return products.select("StockCode", "revenue", "qty", "is_meta")


@query
def pareto_top100(spark, sf_dir):
    best = retail.pareto(_products(spark, sf_dir), "StockCode")
    return best.select(
        "StockCode", "revenue", F.round("cum_rev", 2).alias("cum_rev"),
        F.round("cum_share", 8).alias("cum_share"),
    )


@query
def short_descriptions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", retail.cut_text(F.col("text")).alias("desc_short"))


@query
def word_cut_descriptions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", retail.shorten_words(F.col("text")).alias("desc_short"))


@query
def word_cut_names(spark, sf_dir):
    """Long product texts cut after a whole word."""
    part = table(spark, sf_dir, "part")
    text = F.concat_ws("  ", "p_name", "p_type", "p_brand", "p_name", "p_type", F.lit(" end "))
    return part.select("p_partkey", retail.shorten_words(text).alias("desc_short"))


@query
def retail_job_daily(spark, sf_dir):
    """The whole retail job over a CSV export of the lines, its daily table read back."""
    export = raw_retail_lines(spark, sf_dir).select(
        "InvoiceNo", "StockCode", "Description", "Quantity", "UnitPrice",
        F.date_format("InvoiceDate", "MM/dd/yyyy HH:mm").alias("InvoiceDate"), F.col("CustomerID"),
    )
    raw = sink.write_csv(export, staging_path(spark, "export"))
    written = retail_job(spark, raw, staging_path(spark, "retail"))
    daily = read_csv(spark, written["daily_kpis"])
    return daily.select(
        F.to_timestamp_ntz("date").alias("date"),
        F.col("tx_all").cast("bigint").alias("tx_all"),
        F.col("transactions").cast("bigint").alias("transactions"),
        F.round(F.col("operational_revenue").cast("double"), 2).alias("operational_revenue"),
        F.col("cancellations").cast("bigint").alias("cancellations"),
    )


# ---- line checks -----------------------------------------------------------------------


@query
def gross_net_revenue(spark, sf_dir):
    return retail.gross_net(retail_lines(spark, sf_dir))


@query
def invoice_reconciliation(spark, sf_dir):
    return retail.invoice_reconciliation(retail_lines(spark, sf_dir))


@query
def suspect_invoices_top10(spark, sf_dir):
    found = retail.suspect_invoices(retail_lines(spark, sf_dir))
    return shape.top(found, 10, F.col("neg_lines").desc(), F.col("InvoiceNo").asc())


@query
def negative_lines(spark, sf_dir):
    return retail.negative_lines(retail_lines(spark, sf_dir))


@query
def null_profile(spark, sf_dir):
    return profiles.null_profile(raw_retail_lines(spark, sf_dir))


@query
def identifier_counts(spark, sf_dir):
    return profiles.distinct_counts(
        raw_retail_lines(spark, sf_dir), ["InvoiceNo", "StockCode", "CustomerID"]
    )


@query
def customer_missing_share(spark, sf_dir):
    return profiles.missing_share(raw_retail_lines(spark, sf_dir), "CustomerID")


@query
def missing_customer_rows(spark, sf_dir):
    lines = raw_retail_lines(spark, sf_dir).where("CustomerID is null")
    return shape.top(
        lines.select("InvoiceNo", "StockCode", "Quantity"),
        8, F.col("InvoiceNo").asc(), F.col("StockCode").asc(), F.col("Quantity").asc(),
    )


@query
def date_parse_check(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = orders.select(F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("InvoiceDate"))
    formats = {"month_first": "M/d/yyyy H:mm", "day_first": "d/M/yyyy H:mm"}
    return profiles.date_parse_check(text, "InvoiceDate", formats)


@query
def parsed_invoice_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = orders.select("o_orderkey", F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("InvoiceDate"))
    parsed = retail.parse_invoice_date(text, day_first=True)
    return parsed.groupBy("InvoiceDate").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("InvoiceDate_parsed").isNull()).alias("day_first_failures"),
    )


# ---- customers -------------------------------------------------------------------------


@query
def rfm_scores(spark, sf_dir):
    return rfm.rfm_scores(retail_lines(spark, sf_dir))


@query
def rfm_segments(spark, sf_dir):
    return rfm.rfm_segments(retail_lines(spark, sf_dir))


@query
def rfm_segment_counts(spark, sf_dir):
    return rfm.score_counts(rfm.rfm_scores(retail_lines(spark, sf_dir))).orderBy("RFM_score")


@query
def top_customers(spark, sf_dir):
    return rfm.top_customers(rfm.rfm_scores(retail_lines(spark, sf_dir)))


@query
def rfm_clipped(spark, sf_dir):
    scores = rfm.clipped(rfm.rfm_segments(retail_lines(spark, sf_dir)))
    return scores.select(
        "CustomerID", "recency_clip", F.round("frequency_clip", 4).alias("frequency_clip"),
        F.round("monetary_clip", 4).alias("monetary_clip"),
    )


@query
def rfm_describe(spark, sf_dir):
    scores = rfm.rfm_scores(retail_lines(spark, sf_dir))
    out = profiles.describe(scores, ["recency_days", "frequency", "monetary"])
    return out.withColumns({c: F.round(c, 3) for c in ("mean", "std", "q25", "q50", "q75")})


@query
def rfm_histograms(spark, sf_dir):
    scores = rfm.clipped(rfm.rfm_segments(retail_lines(spark, sf_dir)))
    parts = [
        shape.histogram(scores, f"{name}_clip", 30).select(F.lit(name).alias("metric"), "bin", "n")
        for name in ("recency", "frequency", "monetary")
    ]
    return shape.union_all(parts)


@query
def operational_sample(spark, sf_dir):
    """The variant of the review sample that leaves out bad lines."""
    lines = retail_lines(spark, sf_dir)
    sample = retail.review_sample(lines, keep=~F.col("bad_data"))
    return sample.select("InvoiceNo", "StockCode", "InvoiceDate", "Quantity", "bad_data")
