"""Raw documents to the clean zone as they arrive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from almanac.plans.jobs import clean_documents
from almanac.sources.documents import FILE_SCHEMA, with_key


Consumer = Callable[[SparkSession, str], None]
LEDGER = "stream string, batch_id bigint, consumer string, finished_at timestamp"


def finished(spark: SparkSession, ledger: str, stream: str, batch_id: int) -> set[str]:
    """The consumers that are done with a batch; a row each."""
    try:
        rows = spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException:
        return set()
    own = rows.where((F.col("stream") == stream) & (F.col("batch_id") == batch_id))
    return {r["consumer"] for r in own.select("consumer").collect()}


def record(spark: SparkSession, ledger: str, stream: str, batch_id: int, consumer: str) -> None:
    row = [(stream, batch_id, consumer, dt.datetime.now(dt.timezone.utc))]
    spark.createDataFrame(row, LEDGER).coalesce(1).write.mode("append").parquet(ledger)


def clean_arrivals(
    spark: SparkSession,
    source: str,
    base: str,
    checkpoint: str,
    countries: DataFrame,
    consumers: list[Consumer] | dict[str, Consumer] | None = None,
    files_per_batch: int = 1000,
    glob: str = "*.json",
    decode: bool = False,
) -> StreamingQuery:
    """Start a run over all documents not seen yet under `source` and stop when done.

    After each batch the consumers (analytics, dashboard datasets) run on the clean zone, in order. A
    ledger records who is done with a batch: when a consumer fails, the batch is retried with the
    next start, finds its documents in the manifest, and only runs those that are not done.
    Consumers are known by their names, or places in a list, which should stay the same.
    """
    named = consumers if isinstance(consumers, dict) else {str(i): c for i, c in enumerate(consumers or [])}
    ledger = f"{base.rstrip('/')}/_consumers"
    files = (
        spark.readStream.format("binaryFile")
        .options(
            pathGlobFilter=glob, recursiveFileLookup="true", maxFilesPerTrigger=str(files_per_batch)
        )
        .schema(FILE_SCHEMA)
        .load(source)
    )

    def clean(batch: DataFrame, batch_id: int) -> None:
        clean_documents(with_key(batch, decode), countries, base)
        done = finished(spark, ledger, checkpoint, batch_id)
        for name, consume in named.items():
            if name not in done:
                consume(spark, base)
                record(spark, ledger, checkpoint, batch_id, name)

    return (
        files.writeStream.foreachBatch(clean)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
