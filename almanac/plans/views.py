"""The driver's tables read as retail lines, health indicators and outbreak notices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.operators.retail import bad_data, canonical_lines, settle_adjustments

# Reference date for the queries that look back from "today".
AS_OF = dt.date(2001, 8, 1)
# Which order priority stands for which indicator, and which nation for the one country.
LIFE, CHOLERA, MALARIA, BEDS = "1-URGENT", "2-HIGH", "3-MEDIUM", "BEDS"
COUNTRY = "NATION_3"
REGION = ["NATION_1", "NATION_3", "NATION_5", "NATION_8", "NATION_13", "NATION_17", "NATION_21"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in the shape of a retail export; money is decimal, so sums are exact."""
    line = table(spark, sf_dir, "lineitem")
    order = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    returned = F.col("l_returnflag") == "R"
    code = (
        F.when(F.col("l_partkey") % 97 == 0, "POST")
        .when(F.col("l_partkey") % 89 == 0, "B")
        .otherwise(F.lpad(F.col("l_partkey").cast("string"), 6, "0"))
    )
    cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("double")
    joined = line.join(order, line.l_orderkey == order.o_orderkey).join(
        part, line.l_partkey == part.p_partkey
    )
    quantity = F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    lines = joined.select(
        F.concat(F.when(returned, "C").otherwise(""), F.col("l_orderkey").cast("string")).alias(
            "InvoiceNo"
        ),
        code.alias("StockCode"),
        F.when(code == "B", "Adjust bad debt").otherwise(F.col("p_name")).alias("Description"),
        quantity.alias("Quantity"),
        (cents / F.lit(100.0)).cast("decimal(8,2)").alias("UnitPrice"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey")).alias("CustomerID"),
        F.col("l_orderkey").alias("line_no"),
    )
    total = F.col("Quantity").cast("decimal(4,0)") * F.col("UnitPrice")
    return lines.withColumn("LineTotal", total.cast("decimal(8,2)"))


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with the canonical flags."""
    lines = settle_adjustments(canonical_lines(raw_retail_lines(spark, sf_dir)))
    return lines.withColumn("bad_data", bad_data())


def indicator(spark: SparkSession, sf_dir: str, repeated: bool = False) -> DataFrame:
    """Order value per nation, year and priority; `repeated` gives several rows per key."""
    order = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    keys = ["country_code", "year", "indicator_code"] + (["o_orderstatus"] if repeated else [])
    rows = order.join(customer, order.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    return (
        rows.select(
            F.col("n_name").alias("country_code"),
            F.year("o_orderdate").alias("year"),
            F.col("o_orderpriority").alias("indicator_code"),
            "o_orderstatus",
            F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        )
        .groupBy(*keys)
        .agg(F.sum("price").cast("double").alias("value"))
        .select("country_code", "year", "indicator_code", "value")
    )


def beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped quantity per supplier nation and year."""
    line = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    rows = line.join(supplier, line.l_suppkey == supplier.s_suppkey).join(
        nation, supplier.s_nationkey == nation.n_nationkey
    )
    return (
        rows.groupBy(F.col("n_name").alias("country_code"), F.year("l_shipdate").alias("year"))
        .agg(F.sum("l_quantity").alias("value"))
        .select("country_code", "year", F.lit(BEDS).alias("indicator_id"), "value")
    )


def outbreaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One notice per order; the title is the order's priority with leading blanks."""
    order = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    rows = order.join(customer, order.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    return rows.select(
        F.col("o_orderkey").cast("string").alias("outbreak_id"),
        F.concat(F.lit("  "), "o_orderpriority").alias("title"),
        F.col("n_name").alias("country_iso3"),
        F.col("o_orderdate").alias("publication_date"),
        F.concat(F.lit("/item/"), F.col("o_orderkey").cast("string")).alias("source_url"),
        F.year("o_orderdate").alias("year"),
    )


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One notice title per order in the shapes that titles take in practice."""
    order = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    rows = (
        order.join(customer, order.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    disease = F.col("o_orderpriority")
    name, place = F.col("n_name"), F.initcap("r_name")
    shape = F.col("o_orderkey") % 7
    title = (
        F.when(shape == 0, F.concat(F.lit("Cholera - "), name))
        .when(shape == 1, F.concat(F.lit("Cholera – situation in "), F.lower(name)))
        .when(shape == 2, F.concat(F.lit("Measles update 3 — "), name))
        .when(shape == 3, F.concat(F.lit("Measles cases reported in "), place))
        .when(shape == 4, F.concat(F.lit("Ebola - week 4 - "), name, F.lit(" ")))
        .when(shape == 5, F.concat(F.lit("  "), disease))
        .otherwise(F.lit(" update"))
    )
    return rows.select(
        F.col("o_orderkey"), title.alias("title"), F.col("o_orderdate").alias("publication_date")
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations and regions as a country dimension (30 rows at every scale)."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"),
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("alpha_2"),
        F.concat(F.lit("nn"), F.col("n_nationkey").cast("string")).alias("alpha_3"),
    )
    region = table(spark, sf_dir, "region").select(
        F.initcap("r_name").alias("name"),
        F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("alpha_2"),
        F.concat(F.lit("rr"), F.col("r_regionkey").cast("string")).alias("alpha_3"),
    )
    return nation.unionByName(region)
