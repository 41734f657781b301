"""Batch jobs: the retail KPI run and the raw-to-clean step of the health lake."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.operators import retail, rfm
from almanac.operators.documents import (
    BANK_DATASETS,
    NOTICE_DATASETS,
    notice_records,
    outbreak_rows,
    parsers,
    readable,
    undated_notices,
    unreadable_years,
)
from almanac.sinks import tables as sink
from almanac.session import checkpointed
from almanac.sources.csv import read_csv, read_csv_defensive
from almanac.sources.documents import new_documents

STEPS = ("transform", "daily", "products", "rfm")
# Columns of the canonical lines that no step reads or writes, so they are not kept for the run.
AUDIT = (
    "_invoice_date_orig", "InvoiceDate_parsed", "InvoiceDate_parsed_mf", "is_cancellation_candidate", "negative_revenue",
)


def retail_job(
    spark: SparkSession, raw: str, out: str, steps: Iterable[str] = ("all",), at: dt.datetime | None = None
) -> dict[str, str]:
    """Read a retail export and write the sample, the three summaries and the metadata.

    The canonical lines are kept for the run, as every step reads them; a lost executor
    recomputes its part. Returns the paths written by step.
    """
    wanted = {s.strip().lower() for s in steps}
    wanted = set(STEPS) if "all" in wanted else wanted
    unknown = wanted - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps {sorted(unknown)}, expected some of {STEPS} or all")
    out = out.rstrip("/")
    hashes = sink.write_hashes(spark, f"{out}/metadata.json_hashes", raw)
    lines = retail.settle_adjustments(retail.canonical_lines(read_csv_defensive(spark, raw)))
    lines = lines.drop(*AUDIT).persist(StorageLevel.MEMORY_AND_DISK)
    written: dict[str, str] = {}
    stored: dict[str, DataFrame] = {}
    try:
        if "transform" in wanted:
            sample = retail.review_sample(lines)
            written["sample_kpis"] = sink.write_csv(sample, f"{out}/sample_kpis.csv")
        if "daily" in wanted:
            path = sink.write_daily(retail.daily_kpis(lines), f"{out}/daily_kpis.parquet")
            stored["daily"] = spark.read.parquet(path)
            plain = stored["daily"].drop("year", "year_str", "month_str").orderBy("date")
            written["daily_kpis"] = sink.write_csv(plain, f"{out}/daily_kpis.csv")
        if "products" in wanted:
            products = retail.product_summary(lines, line_order="_line_no")
            path = sink.write_parquet(products, f"{out}/top_products_summary.parquet")
            stored["products"] = spark.read.parquet(path)
            key = retail.product_key(lines)
            ranked = stored["products"].orderBy(F.col("revenue").desc_nulls_last(), F.col(key))
            written["top_products"] = sink.write_csv(ranked, f"{out}/top_products_summary.csv")
        if "rfm" in wanted and "CustomerID" in lines.columns:
            path = sink.write_parquet(rfm.rfm_scores(lines), f"{out}/rfm_customers.parquet")
            stored["rfm"] = spark.read.parquet(path)
            written["rfm"] = sink.write_csv(stored["rfm"], f"{out}/rfm_customers.csv")
        at = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        sink.write_metadata(spark, f"{out}/metadata.json", raw, hashes, stored, at)
    finally:
        lines.unpersist()
    return written


def land_files(spark: SparkSession, source: str, out: str, at: dt.datetime) -> str:
    """CSV files with one header as Parquet, each row with its file and the time it was taken in."""
    return sink.write_parquet(sink.with_source(read_csv(spark, source), at), out)


def _newest_per_year(rows: DataFrame) -> DataFrame:
    """Of each year only the rows of the document that landed last."""
    documents = rows.select("year", "landed_at", "raw_key").distinct()
    newest = documents.groupBy("year").agg(
        F.max(F.struct("landed_at", "raw_key")).alias("_newest")
    ).select("year", F.col("_newest.raw_key").alias("raw_key"))
    return rows.join(newest, ["year", "raw_key"], "left_semi")


def clean_documents(
    documents: DataFrame, countries: DataFrame, base: str, at: dt.datetime | None = None
) -> dict[str, int]:
    """Parse documents not seen before, replace the years they hold, record them.

    The newest document of a batch wins a year, and a year already stored is replaced
    whole. The manifest is written last, so a failed run is repeated without harm.
    Unreadable documents go to `_quarantine` and are not recorded; World Bank records with a
    bad year and notices without a readable date go to `_quarantine_records` with the reason and are
    counted. Returns the numbers by outcome.
    """
    spark = documents.sparkSession
    base = base.rstrip("/")
    at = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    manifest = sink.read_manifest(spark, f"{base}/_manifest")
    fresh = new_documents(documents.where("dataset is not null"), manifest).withColumn(
        "readable", F.coalesce(readable(F.col("body")), F.lit(False))
    )
    fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = {r["readable"]: r["count"] for r in fresh.groupBy("readable").count().collect()}
        if counts.get(False):
            unreadable = fresh.where(~F.col("readable"))
            sink.quarantine(unreadable.select("raw_key", "hash", "landed_at", "body"), f"{base}/_quarantine")
        good = fresh.where("readable")
        names = [r["dataset"] for r in good.select("dataset").distinct().collect()]
        keep = ["raw_key", "landed_at"]
        entries = good.select("raw_key", "hash")
        tallies = []
        outcome = {"processed": counts.get(True, 0), "unreadable": counts.get(False, 0), "bad_records": 0}
        for name, parse in parsers(countries).items():
            if name not in names:
                continue
            own = good.where(F.col("dataset") == name)
            whole = ["raw_key", "hash", "landed_at"]
            bad = None
            if name in NOTICE_DATASETS:  # one parse with two outputs
                records = checkpointed(notice_records(own, whole))
                rows = checkpointed(outbreak_rows(records, countries, keep))
                bad = undated_notices(records, whole)
            else:
                rows = checkpointed(parse(own, keep))  # parsed once for the tally, the choice and the write
            if name in BANK_DATASETS:
                bad = checkpointed(unreadable_years(own, whole)).withColumn("reason", F.lit("unreadable year"))
            n = 0 if bad is None else bad.count()
            if n:
                sink.quarantine(bad, f"{base}/_quarantine_records")
            outcome["bad_records"] += n
            tallies.append(
                rows.groupBy("raw_key", "year").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("raw_key").agg(
                    F.sum("n").alias("rows"), F.count("year").alias("written_partitions")
                )
            )
            clean = _newest_per_year(rows).drop(*keep)
            sink.replace_partitions(clean, f"{base}/{name}", "year")
        if tallies:
            tally = tallies[0]
            for other in tallies[1:]:
                tally = tally.unionByName(other)
            recorded = entries.join(tally, "raw_key", "left").select(
                "raw_key", "hash",
                F.coalesce("rows", F.lit(0)).alias("rows"),
                F.coalesce("written_partitions", F.lit(0)).alias("written_partitions"),
                F.lit(at.isoformat(" ")).cast("timestamp").alias("processed_at"),
            )
            sink.append_manifest(recorded, f"{base}/_manifest")
        sink.append_run_log(spark, f"{base}/_runs", "clean_documents", "done", outcome["processed"])
        return outcome
    finally:
        fresh.unpersist()
