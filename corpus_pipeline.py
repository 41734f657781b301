"""The corpus pipeline: toxicity, near duplicates, secrets, mixing, packing.

Each stage takes the documents its predecessor kept, written as Parquet and read again. The
first four return the columns of documents; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.best_fit_packing import pack_documents
from almanac.llm.common import quoted, stored, table
from almanac.llm.mixing import mix_sources
from almanac.llm.secret_scan import redacted, scan
from almanac.llm.superminhash import without_near_duplicates
from almanac.llm.toxicity import score_texts


def _columns(docs: DataFrame) -> list:
    return [quoted(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted as toxic; learned from the labels that are not held out."""
    scored = score_texts(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return without_near_duplicates(docs).select(*_columns(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a placeholder for every secret and n_chars to match."""
    clean = scan(docs).withColumn("text", redacted(F.col("text"), F.col("spans")))
    changed = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", changed).select(*_columns(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, which may be not at all."""
    copies = F.array_repeat(F.lit(1), F.col("copies").cast("int"))
    return mix_sources(docs).select(*_columns(docs), F.explode(copies).alias("_copy")).drop("_copy")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document copy: doc_id, lang, source, and its place in a sequence."""
    packed = pack_documents(docs.drop("n_chars"), with_ids=False, added=True)
    return packed.drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix),
    ("packing", pack),
]

# The first stage learns a classifier and the last needs a tokenizer, which SQL has not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
