"""Raw JSON documents: one document per file, routed to datasets by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions.hashing import sha256

# Dataset names looked for in a raw key; the first contained one wins (fixed values).
DATASETS = [
    "life_expectancy",
    "malaria_incidence",
    "cholera",
    "wb_hospital_beds_per_1000",
    "wb_physicians_per_1000",
    "who_outbreaks",
]
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
LANDING_TIME = r"(\d{8}T\d{6}Z)"
LANDING_ID = r"\d{8}T\d{6}Z-([0-9a-f]+)\.(?:json|csv)$"


def dataset_of(key: Column, names: list[str] | None = None) -> Column:
    """The first known dataset name contained in the key, NULL if none."""
    return F.coalesce(*[F.when(key.contains(n), F.lit(n)) for n in names or DATASETS])


def landed_at(key: Column) -> Column:
    """Ingest time in a key named `<UTC time>-<id>.<json|csv>`, NULL for other names."""
    text = F.nullif(F.regexp_extract(key, LANDING_TIME, 1), F.lit(""))
    return F.try_to_timestamp(text, F.lit("yyyyMMdd'T'HHmmss'Z'"))


def landing_id(key: Column) -> Column:
    return F.nullif(F.regexp_extract(key, LANDING_ID, 1), F.lit(""))


def extension_for(content_type: Column) -> Column:
    """`csv` if the content type says so, else `json`."""
    is_csv = F.coalesce(F.lower(content_type).contains("csv"), F.lit(False))
    return F.when(is_csv, "csv").otherwise("json")


def landing_key(dataset: Column, at: Column, content: Column, content_type: Column) -> Column:
    """A raw key for a payload; its id comes from the content, so a retry gives the same key."""
    return F.concat(
        dataset, F.lit("/"), F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"), F.lit("-"),
        F.substring(sha256(content), 1, 32), F.lit("."), extension_for(content_type),
    )


def with_key(files: DataFrame, decode: bool = False) -> DataFrame:
    """Key, dataset, landing time, hash and text of files read as binary.

    Keys that arrive URL-encoded are decoded on request.
    """
    key = F.url_decode("path") if decode else F.col("path")
    return files.select(key.alias("raw_key"), "modificationTime", "content").select(
        "raw_key",
        dataset_of(F.col("raw_key")).alias("dataset"),
        F.coalesce(landed_at(F.col("raw_key")), F.col("modificationTime")).alias("landed_at"),
        sha256(F.col("content")).alias("hash"),
        F.col("content").cast("string").alias("body"),
    )


def read_documents(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """All documents under a path; a document is the unit of the scan and is read whole."""
    reader = spark.read.format("binaryFile").options(pathGlobFilter=glob, recursiveFileLookup="true")
    return with_key(reader.load(path))


def unchanged(manifest: DataFrame) -> DataFrame:
    """The last recorded hash of each key."""
    return manifest.groupBy("raw_key").agg(F.max_by("hash", "processed_at").alias("hash"))


def new_documents(documents: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Documents whose key is unknown or whose content differs from the last recorded one."""
    if manifest is None:
        return documents
    return documents.join(unchanged(manifest), ["raw_key", "hash"], "left_anti")
