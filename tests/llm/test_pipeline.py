"""Each stage of the pipeline against its operator, on the smallest tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from almanac.llm import best_fit_packing, mixing, secret_scan, superminhash, toxicity
from tests.llm.rows import HAVE_TABLES, SF_DIR

pytestmark = pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_toxicity_stage_drops_what_is_predicted(spark):
    # the smallest tables have too few labels to learn from
    tables = SF_DIR.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{tables}/{name}.parquet") for name in ("documents", "labels"))
    predicted = toxicity.score_texts(docs, labels).where("predicted = 1").select("doc_id")
    want = docs.join(predicted, "doc_id", "left_anti").select(*docs.columns)
    got = STAGES["toxicity"](spark, docs, tables)
    assert rows(got) == rows(want) and got.count() < docs.count()


def test_near_duplicate_stage_keeps_one_of_each_group(spark, docs):
    groups = superminhash.near_duplicates(docs).where("kept").select("doc_id")
    want = docs.join(groups, "doc_id", "left_semi").select(*docs.columns)
    got = STAGES["near_duplicates"](spark, docs, SF_DIR)
    assert rows(got) == rows(want)
    # a second pass finds nothing left to drop
    assert superminhash.near_duplicates(got).where("not kept").count() == 0


def test_secret_stage_replaces_every_span(spark, docs):
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.scan(docs).select("doc_id", "spans").collect()}
    before = {r["doc_id"]: r for r in docs.collect()}
    after = {r["doc_id"]: r for r in STAGES["secrets"](spark, docs, SF_DIR).collect()}
    assert after.keys() == before.keys() and any(spans.values())
    for key, row in before.items():
        text, places = row["text"], sorted({(s["start"], s["end"]) for s in spans[key] or []})
        merged = []
        for start, end in places:
            if merged and start < merged[-1][1]:
                merged[-1][1] = max(end, merged[-1][1])
            else:
                merged.append([start, end])
        for start, end in reversed(merged):
            text = text[:start] + secret_scan.PLACEHOLDER + text[end:]
        assert after[key]["text"] == text
        assert after[key]["n_chars"] == (len(text) if merged else row["n_chars"])


def test_mixing_stage_repeats_documents_as_taken(spark, docs):
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(docs).select("doc_id", "copies").collect()}
    got = Counter(r["doc_id"] for r in STAGES["mixing"](spark, docs, SF_DIR).select("doc_id").collect())
    assert got == Counter({k: n for k, n in copies.items() if n})


def test_packing_stage_places_every_document(spark, docs):
    want = best_fit_packing.pack_documents(docs, with_ids=False, added=True).select("doc_id", "piece", "length")
    got = STAGES["packing"](spark, docs, SF_DIR)
    assert rows(got.select("doc_id", "piece", "length")) == rows(want)
    ends = got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert ends.where("n <> end or n > 1024").count() == 0


def test_run_goes_through_all_stages(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert out.columns == docs.columns
    assert Counter(r[0] for r in out.select("doc_id").collect()) == Counter(r[0] for r in docs.select("doc_id").collect())
