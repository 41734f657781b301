"""Retail lines: canonical flags, daily KPIs, product summary and line-level checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions.dates import (
    DAY_FIRST_FORMATS,
    INVOICE_FORMATS,
    floor_day,
    week_ending_sunday,
)
from almanac.functions.numbers import is_true, share_of, to_number
from almanac.operators.shape import require_columns, trim_names
from almanac.session import checkpointed

# Candidate product keys, first match wins (fixed values).
PRODUCT_KEYS = ["StockCode", "ProductID", "ItemID", "SKU", "Product"]
ADJUSTMENT_CODE = "B"
ADJUSTMENT_TEXT = "ADJUST|BAD DEBT|ADJUSTMENT"
DEBT_TEXT = "%ADJUST BAD DEBT%"
FAILURE_LIMIT = 0.05
DAY_MA_ROWS = 7


# ---- canonical transform ---------------------------------------------------------------


def _unread(df: DataFrame, column: str, formats: list[str]) -> DataFrame:
    """One row: the number of rows, and by each format's place the rows whose date it cannot read.

    Each text is tried once and stands for all its rows, as a failed parse is what costs.
    """
    texts = df.groupBy(F.trim(F.col(column)).alias("_text")).agg(F.count(F.lit(1)).alias("_rows"))

    def total(rows: Column) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0))

    return texts.agg(
        total(F.col("_rows")).alias("rows"),
        *[
            total(F.when(F.try_to_timestamp("_text", F.lit(f)).isNull(), F.col("_rows"))).alias(str(i))
            for i, f in enumerate(formats)
        ],
    )


def _best_format(df: DataFrame, column: str, formats: list[str]) -> tuple[str, int, int]:
    """The one format that leaves the fewest dates unread, with its failures and the row count."""
    counts = _unread(df, column, formats).first()
    best = min(range(len(formats)), key=lambda i: (counts[str(i)], i))
    return formats[best], counts[str(best)], counts["rows"]


def parse_invoice_date(
    df: DataFrame, column: str = "InvoiceDate", day_first: bool = False
) -> DataFrame:
    """Parse the date column with one format for the whole column and keep audit copies.

    When more than 5 % of the rows fail, the month-first reading is kept beside it and
    replaces it if it fails less often.
    """
    if column not in df.columns:
        return df
    original = df.withColumn("_invoice_date_orig", F.col(column))
    if _type_name(df, column) != "string":
        return original.withColumns(
            {"InvoiceDate_parsed": F.col(column), "InvoiceDate": F.col(column)}
        )
    text = F.trim(F.col("_invoice_date_orig"))
    formats = DAY_FIRST_FORMATS + INVOICE_FORMATS[3:] if day_first else INVOICE_FORMATS
    best, failed, rows = _best_format(df, column, formats)
    parsed = F.try_to_timestamp(text, F.lit(best)).cast("timestamp_ntz")
    out = original.withColumn("InvoiceDate_parsed", parsed)
    if failed <= FAILURE_LIMIT * rows:
        return out.withColumn("InvoiceDate", F.col("InvoiceDate_parsed"))
    other, other_failed, _ = _best_format(df, column, INVOICE_FORMATS)
    month_first = F.try_to_timestamp(text, F.lit(other)).cast("timestamp_ntz")
    out = out.withColumn("InvoiceDate_parsed_mf", month_first)
    chosen = "InvoiceDate_parsed_mf" if other_failed < failed else "InvoiceDate_parsed"
    return out.withColumn("InvoiceDate", F.col(chosen))


def _type_name(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.typeName()


def _upper(column: str) -> Column:
    return F.upper(F.col(column).cast("string"))


def is_cancellation(column: str = "InvoiceNo") -> Column:
    return is_true(_upper(column).startswith("C"))


def is_adjustment(code: str = "StockCode", text: str = "Description") -> Column:
    return is_true((_upper(code) == ADJUSTMENT_CODE) & _upper(text).rlike(ADJUSTMENT_TEXT))


def is_debt_adjustment(
    code: str = "StockCode", text: str = "Description", total: str = "LineTotal"
) -> Column:
    """The narrower rule: the full phrase and a negative line."""
    return is_true((_upper(code) == ADJUSTMENT_CODE) & F.col(text).ilike(DEBT_TEXT) & (F.col(total) < 0))


def is_meta_key(column: str) -> Column:
    """Codes of at most three characters or of capital letters only are not products."""
    key = F.col(column).cast("string")
    return is_true((F.length(key) <= 3) | key.rlike(r"^[A-Z]+$"))


def bad_data(date: str = "InvoiceDate", total: str = "LineTotal") -> Column:
    return F.col(date).isNull() | F.col(total).isNull()


def canonical_lines(
    df: DataFrame, date_column: str = "InvoiceDate", day_first: bool = False
) -> DataFrame:
    """Trim names, parse dates and numbers, add LineTotal and the flags. No row is dropped."""
    out = parse_invoice_date(trim_names(df), date_column, day_first)
    texts = [c for c in ("UnitPrice", "Price", "Quantity") if c in out.columns]
    texts = [c for c in texts if _type_name(out, c) == "string"]
    if texts:
        out = out.withColumns({c: to_number(F.col(c)) for c in texts})
    if "LineTotal" not in out.columns:
        if {"UnitPrice", "Quantity"} <= set(out.columns):
            total = F.col("UnitPrice") * F.col("Quantity")
        elif "Price" in out.columns:
            total = F.col("Price")
        else:
            total = F.lit(None).cast("double")
        out = out.withColumn("LineTotal", total)
    cancelled = is_cancellation() if "InvoiceNo" in out.columns else F.lit(False)
    described = {"StockCode", "Description"} <= set(out.columns)
    adjusted = is_adjustment() if described else F.lit(False)
    return out.withColumns(
        {
            "is_cancellation_candidate": cancelled,
            "negative_revenue": is_true(F.col("LineTotal") < 0),
            "is_cancellation": cancelled,
            "is_adjustment": adjusted,
            "is_operational": ~cancelled & ~adjusted & F.col("LineTotal").isNotNull(),
        }
    )


def settle_adjustments(df: DataFrame) -> DataFrame:
    """Mark negative lines that meet the adjustment rule and recompute the operational flag.

    After `canonical_lines` this changes nothing, as that rule has no sign condition; it
    matters for frames whose flags come from elsewhere.
    """
    require_columns(df, ["LineTotal", "is_cancellation", "is_adjustment"], "settle_adjustments")
    adjusted = F.col("is_adjustment")
    if {"StockCode", "Description"} <= set(df.columns):
        adjusted = adjusted | (is_adjustment() & is_true(F.col("LineTotal") < 0))
    return df.withColumn("is_adjustment", adjusted).withColumn(
        "is_operational",
        ~F.col("is_cancellation") & ~F.col("is_adjustment") & F.col("LineTotal").isNotNull(),
    )


def review_sample(df: DataFrame, n: int = 500, keep: Column | None = None) -> DataFrame:
    """The newest n lines with a total, as far as the preferred columns exist."""
    preferred = [
        "InvoiceDate", "InvoiceNo", "CustomerID", "StockCode", "Description", "Quantity",
        "UnitPrice", "LineTotal", "is_cancellation", "is_adjustment", "is_operational", "bad_data",
    ]
    present = [c for c in preferred if c in df.columns]
    kept = df.where(F.col("LineTotal").isNotNull() if keep is None else keep).select(*present)
    ties = [F.col(c).asc_nulls_last() for c in present if c != "InvoiceDate"]
    return kept.orderBy(F.col("InvoiceDate").desc_nulls_last(), *ties).limit(n)


# ---- daily figures ---------------------------------------------------------------------


def _dated(df: DataFrame) -> DataFrame:
    require_columns(df, ["InvoiceDate"], "daily figures")
    if _type_name(df, "InvoiceDate") not in ("timestamp", "timestamp_ntz", "date"):
        raise ValueError("InvoiceDate is not a timestamp: run canonical_lines first")
    return df.withColumn("date", floor_day(F.col("InvoiceDate"))).where("date is not null")


def daily_kpis(df: DataFrame) -> DataFrame:
    """Lines, operational invoices and revenue, cancelled lines and mean invoice value per day.

    The mean of the invoice sums of a day equals their total over the number of invoices,
    so one aggregate with one distinct count serves all columns: Spark combines by
    (date, invoice) before the shuffle and no date or invoice is gathered whole.
    """
    lines = _dated(df)
    operational = F.col("is_operational")
    revenue = F.sum(F.when(operational, F.col("LineTotal"))).cast("double")
    figures = [
        F.count(F.lit(1)).alias("tx_all"),
        F.coalesce(revenue, F.lit(0.0)).alias("operational_revenue"),
        F.count_if(F.col("is_cancellation")).alias("cancellations"),
    ]
    if "InvoiceNo" not in lines.columns:
        return (
            lines.groupBy("date")
            .agg(F.count_if(operational).alias("transactions"), *figures)
            .withColumn("aov", F.lit(0.0))
        )
    invoiced = operational & F.col("InvoiceNo").isNotNull()
    grouped = lines.groupBy("date").agg(
        F.count_distinct(F.when(invoiced, F.col("InvoiceNo"))).alias("transactions"),
        F.sum(F.when(invoiced, F.col("LineTotal"))).cast("double").alias("_invoiced"),
        *figures,
    )
    mean = F.try_divide(F.col("_invoiced"), F.col("transactions"))
    return grouped.select(
        "date", "tx_all", "transactions", "operational_revenue", "cancellations",
        F.coalesce(mean, F.lit(0.0)).alias("aov"),
    )


def daily_operations(df: DataFrame) -> DataFrame:
    """Revenue, orders, items and active customers per day of uncancelled, unadjusted lines.

    Two distinct counts in one aggregate would multiply every line, so lines are first
    combined to (date, invoice, customer).
    """
    lines = _dated(df).where(~F.col("is_cancellation") & ~F.col("is_adjustment"))
    combined = lines.groupBy("date", "InvoiceNo", "CustomerID").agg(
        F.sum("LineTotal").alias("_revenue"), F.sum("Quantity").alias("_items")
    )
    return combined.groupBy("date").agg(
        F.coalesce(F.sum("_revenue").cast("double"), F.lit(0.0)).alias("daily_revenue"),
        F.count_distinct("InvoiceNo").alias("daily_orders"),
        F.coalesce(F.sum("_items").cast("double"), F.lit(0.0)).alias("daily_items"),
        F.count_distinct("CustomerID").alias("active_customers"),
    )


def moving_average(
    daily: DataFrame, value: str, name: str, rows: int = DAY_MA_ROWS, date: str = "date"
) -> DataFrame:
    """Mean of this and the rows-1 rows before, in date order.

    `daily` has one row per calendar day (at most a few million for all dates a timestamp
    can hold), so the window without partitions is bounded.
    """
    recent = Window.orderBy(date).rowsBetween(1 - rows, 0)
    return daily.withColumn(name, F.avg(value).over(recent))


def weekly_totals(daily: DataFrame, value: str, name: str, date: str = "date") -> DataFrame:
    """Sum per week ending on Sunday; weeks without a day get 0."""
    week = week_ending_sunday(F.col(date))
    # at most one row per calendar week, stored as it is read twice
    sums = checkpointed(daily.groupBy(week.alias("week")).agg(F.sum(value).alias("_sum")))
    span = sums.agg(F.min("week").alias("lo"), F.max("week").alias("hi"))
    weeks = span.where("lo is not null").select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 7 days"))).alias("week")
    )
    return weeks.join(sums, "week", "left").select(
        F.col("week").cast("timestamp_ntz").alias(date),
        F.coalesce(F.col("_sum").cast("double"), F.lit(0.0)).alias(name),
    )


def missing_days(df: DataFrame, date: str = "date") -> DataFrame:
    """Calendar days between the first and the last day that have no row."""
    days = df.select(F.col(date).cast("date").alias("date")).where("date is not null").distinct()
    days = checkpointed(days)  # at most one row per calendar day, read twice
    span = days.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    full = span.where("lo is not null").select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date")
    )
    return full.join(days, "date", "left_anti").select(F.col("date").cast("timestamp_ntz").alias("date"))


def daily_activity(df: DataFrame) -> DataFrame:
    """All and operational lines per day with operational revenue."""
    operational = ~F.col("is_cancellation") & ~F.col("is_adjustment")
    return _dated(df).groupBy("date").agg(
        F.count(F.lit(1)).alias("tx_all"),
        F.count_if(operational).alias("tx_operational"),
        F.coalesce(
            F.sum(F.when(operational, F.col("LineTotal"))).cast("double"), F.lit(0.0)
        ).alias("operational_revenue"),
    )


def daily_lines(df: DataFrame) -> DataFrame:
    """Lines and revenue per day, cancellations left out and adjustments left in."""
    return _dated(df.where(~F.col("is_cancellation"))).groupBy("date").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.coalesce(F.sum("LineTotal").cast("double"), F.lit(0.0)).alias("operational_revenue"),
    )


def bad_share_by_day(df: DataFrame, above: float | None = None) -> DataFrame:
    """Share of bad lines per day, optionally only days above a limit."""
    shares = _dated(df).groupBy("date").agg(
        F.avg(F.coalesce(F.col("bad_data"), F.lit(True)).cast("double")).alias("bad_frac")
    )
    return shares if above is None else shares.where(F.col("bad_frac") > above)


def headline(daily: DataFrame) -> DataFrame:
    """One row: revenue, transactions, mean of the daily order values, days with cancellations."""
    return daily.agg(
        F.coalesce(F.sum("operational_revenue"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.sum("transactions"), F.lit(0)).cast("bigint").alias("total_transactions"),
        F.avg("aov").alias("mean_aov"),
        F.count_if(F.col("cancellations") > 0).alias("days_with_cancellations"),
    )


# ---- products --------------------------------------------------------------------------


def product_key(df: DataFrame, candidates: list[str] | None = None) -> str:
    names = candidates or PRODUCT_KEYS
    found = next((c for c in names if c in df.columns), None)
    if found is None:
        raise ValueError(f"no product column found, expected one of {names}")
    return found


def cut_text(text: Column) -> Column:
    """Texts over 60 characters become their first 57 and three dots."""
    cut = F.concat(F.substring(text, 1, 57), F.lit("..."))
    return F.when(F.length(text) > 60, cut).otherwise(text)


def shorten_words(text: Column, width: int = 60, mark: str = "...") -> Column:
    """Collapse blanks and cut after a whole word, or after a hyphen inside one."""
    flat = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    letter = r"[\p{L}_]"
    hyphen = rf"(?:(?<={letter}{{2}}-)|(?<={letter}-{letter}-))(?={letter}-?{letter})"
    # the longest head that leaves room for the mark; the mark alone if no word fits
    head = F.regexp_extract(flat, rf"^(.{{1,{width - len(mark)}}}(?:(?= )|{hyphen}))", 1)
    return F.when(F.length(flat) <= width, flat).otherwise(F.concat(head, F.lit(mark)))


def product_summary(
    df: DataFrame,
    candidates: list[str] | None = None,
    line_order: str | None = None,
    with_orders: bool = False,
) -> DataFrame:
    """Revenue, quantity, lines, customers, description and shares per product.

    Lines are first combined to (product, description, customer): a hot product is reduced
    on the map side, and the text is a grouping key rather than an aggregate buffer, which
    keeps the pass over the lines a hash aggregate. The description is the first by
    `line_order`, a column that gives the input order. `with_orders` adds the number of
    invoices and the word-boundary short text.
    """
    key = product_key(df, candidates)
    require_columns(df, ["InvoiceNo", "CustomerID"], "product summary")
    lines = df.where(
        ~F.col("is_cancellation") & ~F.col("is_adjustment") & F.col("LineTotal").isNotNull()
    ).where(F.col(key).isNotNull())
    if "Quantity" not in lines.columns:
        lines = lines.withColumn("Quantity", F.lit(0.0))
    if "Description" not in lines.columns:
        lines = lines.withColumn("Description", F.lit(None).cast("string"))
    lines = lines.withColumn(
        "_order", F.col(line_order) if line_order else F.monotonically_increasing_id()
    )
    grain = [key, "Description", "CustomerID"] + (["InvoiceNo"] if with_orders else [])
    combined = lines.groupBy(*grain).agg(
        F.sum("LineTotal").alias("_revenue"),
        F.sum("Quantity").alias("_qty"),
        F.count("InvoiceNo").alias("_lines"),
        F.min("_order").alias("_first"),
    )
    described = F.when(
        F.col("Description").isNotNull(), F.struct("_first", F.col("Description").alias("text"))
    )
    figures = [
        F.sum("_revenue").alias("_revenue"),
        F.sum("_qty").alias("_qty"),
        F.sum("_lines").alias("tx_lines"),
        F.count_distinct("CustomerID").alias("distinct_customers"),
        F.coalesce(F.min(described)["text"], F.lit("")).alias("description"),
    ]
    if with_orders:
        figures.append(F.count_distinct("InvoiceNo").alias("n_orders"))
    # stored, as the totals need the products too: the lines are read once
    products = checkpointed(combined.groupBy(key).agg(*figures))
    totals = products.agg(
        F.struct(
            F.sum("_revenue").cast("double").alias("revenue"),
            F.sum("_qty").cast("double").alias("qty"),
        ).alias("total")
    )
    short = shorten_words if with_orders else cut_text
    whole = products.withColumns(
        {
            "revenue": F.coalesce(F.col("_revenue").cast("double"), F.lit(0.0)),
            "qty": F.coalesce(F.col("_qty").cast("double"), F.lit(0.0)),
            "_total": totals.scalar(),
        }
    )
    extra = ["n_orders"] if with_orders else []
    return whole.select(
        key, "revenue", "qty", "tx_lines", "distinct_customers", *extra, "description",
        short(F.col("description")).alias("desc_short"),
        F.when(F.col("qty") != 0, F.col("revenue") / F.col("qty")).alias("avg_price"),
        share_of(F.col("revenue"), F.col("_total.revenue")).alias("rev_share"),
        share_of(F.col("qty"), F.col("_total.qty")).alias("qty_share"),
        is_meta_key(key).alias("is_meta"),
    )


def without_meta(products: DataFrame) -> DataFrame:
    """Only real products; all rows if nothing would be left."""
    any_real = products.agg(F.coalesce(F.bool_or(~F.col("is_meta")), F.lit(False)))
    return products.where(~F.col("is_meta") | ~any_real.scalar())


def top_products(
    products: DataFrame, key: str, n: int = 10, by: str = "revenue", meta: bool = False
) -> DataFrame:
    rows = products if meta else products.where(~F.col("is_meta"))
    return rows.orderBy(F.col(by).desc_nulls_last(), F.col(key).asc()).limit(n)


def pareto(products: DataFrame, key: str, n: int = 100) -> DataFrame:
    """The n best products with their running revenue and its share of the n products' sum."""
    best = top_products(products, key, n)
    # the window sees n rows
    upto = Window.orderBy(F.col("revenue").desc_nulls_last(), F.col(key)).rowsBetween(
        Window.unboundedPreceding, 0
    )
    whole = Window.orderBy(F.col("revenue").desc_nulls_last(), F.col(key)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return best.withColumn("cum_rev", F.sum("revenue").over(upto)).withColumn(
        "cum_share", F.col("cum_rev") / F.sum("revenue").over(whole)
    )


# ---- line-level checks -----------------------------------------------------------------


def gross_net(df: DataFrame) -> DataFrame:
    """One row: gross and net revenue, cancelled and negative lines with their shares."""
    rows = F.count(F.lit(1))
    return df.agg(
        F.coalesce(F.sum("LineTotal").cast("double"), F.lit(0.0)).alias("gross_revenue"),
        F.coalesce(
            F.sum(F.when(~F.col("is_cancellation"), F.col("LineTotal"))).cast("double"), F.lit(0.0)
        ).alias("net_revenue"),
        F.count_if("is_cancellation").alias("cancel_rows"),
        F.try_divide(F.count_if("is_cancellation"), rows).alias("cancel_share"),
        F.count_if("negative_revenue").alias("negative_rows"),
        F.try_divide(F.count_if("negative_revenue"), rows).alias("negative_share"),
    )


def invoice_reconciliation(df: DataFrame) -> DataFrame:
    """Lines, sum, positive and negative lines of each invoice, and whether one is cancelled."""
    return (
        df.where(F.col("InvoiceNo").isNotNull())
        .groupBy("InvoiceNo")
        .agg(
            F.count("LineTotal").alias("lines"),
            F.coalesce(F.sum("LineTotal").cast("double"), F.lit(0.0)).alias("sum_line"),
            F.count_if(F.col("LineTotal") > 0).alias("pos_lines"),
            F.count_if(F.col("LineTotal") < 0).alias("neg_lines"),
            F.bool_or("is_cancellation").alias("is_cancel_any"),
        )
    )


def suspect_invoices(df: DataFrame) -> DataFrame:
    return invoice_reconciliation(df).where((F.col("neg_lines") > 0) | F.col("is_cancel_any"))


def negative_lines(df: DataFrame) -> DataFrame:
    """One row: negative lines by explanation and those left unexplained."""
    negative = F.col("negative_revenue")
    cancelled, adjusted = F.col("is_cancellation"), F.col("is_adjustment")
    return df.agg(
        F.count_if(negative).alias("negative_rows"),
        F.count_if(negative & cancelled).alias("cancelled"),
        F.count_if(negative & adjusted).alias("adjusted"),
        F.count_if(negative & ~cancelled).alias("outside_cancellations"),
        F.count_if(negative & ~cancelled & ~adjusted).alias("residual"),
    )


def cancellation_rate(df: DataFrame) -> DataFrame:
    """One row: cancelled lines, their share, and the number of customers."""
    return df.agg(
        F.count_if("is_cancellation").alias("cancelled_lines"),
        F.try_divide(F.count_if("is_cancellation"), F.count(F.lit(1))).alias("cancellation_rate"),
        F.count_distinct("CustomerID").alias("total_customers"),
    )


def explicit_cancellations(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n invoices with an explicit `Cancelled` value; none if there is no such column."""
    if "Cancelled" not in df.columns:
        return df.select("InvoiceNo", F.lit(None).cast("string").alias("Cancelled")).limit(0)
    marked = df.select("InvoiceNo", "Cancelled").dropna()
    return marked.orderBy("InvoiceNo", "Cancelled").limit(n)
