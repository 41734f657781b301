"""Quality checks on CSV files as they arrive: one report per file."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from almanac.operators.file_quality import check_files, issue_documents, write_reports
from almanac.operators.quality import Rule
from almanac.sources.csv import read_csv_cells
from almanac.sources.documents import FILE_SCHEMA


def _store(frame: DataFrame, path: str, batch: int) -> None:
    # one folder per batch, overwritten on a retry of the same batch
    frame.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def check_arrivals(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    rules: list[Rule] | None = None,
    files_per_batch: int = 1000,
    encoding: str = "UTF-8",
    multiline: bool = False,
) -> StreamingQuery:
    """Start a run over all files not seen yet under `source` and stop when done.

    The stream carries only the paths of new files, at most `files_per_batch` at a time;
    each batch reads its files as one distributed scan. Writes `files`, `columns`, `issues`
    and, one document per file under its own key, `reports` under `out`.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .options(
            pathGlobFilter="*.csv", recursiveFileLookup="true", maxFilesPerTrigger=str(files_per_batch)
        )
        .schema(FILE_SCHEMA)
        .load(source)
        .select("path")
    )

    def check(batch: DataFrame, batch_id: int) -> None:
        paths = [row["path"] for row in batch.collect()]  # bounded by files_per_batch
        if not paths:
            return
        session = batch.sparkSession
        checked = check_files(
            read_csv_cells(session, paths, encoding=encoding, multiline=multiline), rules
        )
        at = F.lit(dt.datetime.now(dt.timezone.utc))
        _store(issue_documents(checked), f"{out}/issues", batch_id)
        _store(checked.columns, f"{out}/columns", batch_id)
        _store(checked.files.withColumn("checked_at", at), f"{out}/files", batch_id)
        write_reports(checked, source, out)

    return (
        arrivals.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
