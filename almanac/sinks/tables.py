"""Table sinks: partitioned Parquet, CSV, exports, manifest and run records."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions.dates import month_label, year_label
from almanac.session import checkpointed
from almanac.sinks.objects import open_store

HASH_PIECE = 1 << 20
MANIFEST_COLUMNS = (
    "raw_key string, hash string, rows bigint, written_partitions bigint, processed_at timestamp"
)
NOTICE_EXPORT = [
    "outbreak_id", "title", "summary", "publication_date", "country_guid", "disease_topic",
]


def write_csv(df: DataFrame, path: str, timestamps: str | None = None) -> str:
    options = {
        "header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    if timestamps:
        options |= {"timestampFormat": timestamps, "timestampNTZFormat": timestamps}
    df.write.mode("overwrite").options(**options).csv(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_daily(daily: DataFrame, path: str) -> str:
    """Daily KPIs partitioned by year and month text."""
    labelled = daily.withColumns(
        {
            "year": F.year("date"),
            "year_str": year_label(F.col("date")),
            "month_str": month_label(F.col("date")),
        }
    )
    # one row per day: a single small file per month is the right size
    labelled.repartition("year_str", "month_str").write.mode("overwrite").partitionBy(
        "year_str", "month_str"
    ).parquet(path)
    return path


def replace_partitions(df: DataFrame, path: str, *by: str) -> str:
    """Replace only the partitions present in `df`.

    The rebalance hint gathers small partitions into few files and splits a partition that
    holds much of the data over several tasks.
    """
    df.hint("rebalance", *by).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*by).parquet(path)
    return path


def with_source(df: DataFrame, at: dt.datetime) -> DataFrame:
    """Provenance columns of rows read from files."""
    return df.withColumns(
        {"source_file": F.col("_metadata.file_name"), "ingested_at": F.lit(at)}
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST_COLUMNS).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST_COLUMNS)


def append_manifest(entries: DataFrame, path: str) -> None:
    """Append processed keys. Written after their data, so a retry only repeats the work."""
    names = [c.split()[0] for c in MANIFEST_COLUMNS.split(", ")]
    entries.select(*names).write.mode("append").parquet(path)


def quarantine(documents: DataFrame, path: str) -> None:
    """Keep unreadable documents, each content of a key once."""
    try:
        kept = documents.sparkSession.read.schema(documents.schema).parquet(path)
        documents = documents.join(kept.select("raw_key", "hash"), ["raw_key", "hash"], "left_anti")
    except AnalysisException:
        pass  # nothing kept yet
    documents.write.mode("append").parquet(path)


def append_run_log(spark: SparkSession, path: str, job: str, outcome: str, rows: int) -> None:
    """One row per run, also for a run that found nothing to do."""
    row = [(job, outcome, rows, dt.datetime.now(dt.timezone.utc))]
    spark.createDataFrame(row, "job string, outcome string, rows bigint, finished_at timestamp").write.mode(
        "append"
    ).parquet(path)


def export_result(
    df: DataFrame, path: str, name: str, json_lines: bool = True, csv: bool = True
) -> dict:
    """Write a query result as JSON records and CSV and return its run metrics.

    The result is evaluated once and stored; the formats are written from what was stored.
    """
    start = time.perf_counter()
    outputs = []
    stored = checkpointed(df)
    for wanted, kind in ((json_lines, "json"), (csv, "csv")):
        if not wanted:
            continue
        target = f"{path.rstrip('/')}/{name}.{kind}"
        if kind == "json":
            stored.write.mode("overwrite").json(target)
        else:
            write_csv(stored, target, timestamps="yyyy-MM-dd HH:mm:ss")
        outputs.append(target)
    rows = stored.count()
    return {
        "query": name,
        "rows": rows,
        "duration_ms": int((time.perf_counter() - start) * 1000),
        "outputs": outputs,
        "formats": {"json": json_lines, "csv": csv},
    }


def write_query_metrics(spark: SparkSession, metrics: list[dict], path: str) -> None:
    rows = [
        (m["query"], m["rows"], m["duration_ms"], m["outputs"], m["formats"]) for m in metrics
    ]
    spark.createDataFrame(
        rows,
        "query string, rows bigint, duration_ms bigint, outputs array<string>, formats map<string,boolean>",
    ).coalesce(1).write.mode("overwrite").json(path)


def _hash_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for path in batch["path"]:
            system, place = open_store(path)
            digest = hashlib.sha256()
            with system.open_input_stream(place) as stream:
                while piece := stream.read(HASH_PIECE):
                    digest.update(piece)
            found.append((path, digest.hexdigest()))
        yield pd.DataFrame(found, columns=["path", "sha256"])


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of each raw file of any size, read in pieces by the task that has its path; empty files are not listed."""
    # only paths are listed, so no file becomes a value of a row
    files = spark.read.format("binaryFile").load(path).select("path")
    return files.mapInPandas(_hash_files, "path string, sha256 string")


def write_hashes(spark: SparkSession, path: str, source: str) -> str:
    """The hashes of a source's files as a table; written first, so an unreadable file stops a job early."""
    return write_parquet(file_hashes(spark, source), path)


def write_metadata(
    spark: SparkSession, path: str, source: str, hashes: str, tables: dict[str, DataFrame], at: dt.datetime
) -> dict:
    """Run metadata as one JSON document: time, row counts, columns, source and the table of its hashes.

    `tables` are written results read back, so counting them only reads footers.
    """
    meta = {
        "generated_at": at.isoformat() + "Z",
        "rows": {name: df.count() for name, df in tables.items()},
        "input_raw_file_hash": {"table": hashes},
        "columns": {name: df.columns for name, df in tables.items()},
        "source": source,
    }
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)
    return meta
