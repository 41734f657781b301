"""Session settings and the shared folder used for checkpoints and staging."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app: str = "almanac", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings the jobs rely on; `settings` win over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by `spark.checkpoint.dir`.

    Only a local master, where driver and executors are one process, may fall back
    to a folder of its own; on a cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="almanac-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, unique to one run."""
    return f"{shared_root(spark).rstrip('/')}/staging/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Store `df` as Parquet in the shared folder and return it read back, its lineage cut.

    Used where a frame is read more than once and a second evaluation could differ
    (sampled range bounds) or would repeat a large shuffle. A lost executor only means
    reading the files again; later reads take only the columns they need, and the planner
    knows the size.
    """
    path = staging_path(df.sparkSession, "frame")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
