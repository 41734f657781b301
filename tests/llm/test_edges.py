"""Awkward rows through every operator, with the result each docstring states."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from almanac.llm import (
    best_fit_packing,
    crf_language,
    divergence,
    license_join,
    merkle,
    mixing,
    superminhash,
    toxicity,
)
from tests.llm.rows import HAVE_TABLES, SF_DIR, awkward, empty

LABELS = "doc_id bigint, quality int, toxic int"


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (10, 1, 1), (None, 1, 1), (6, None, None)], LABELS)


def by_id(df):
    out = {}
    for row in df.collect():
        out.setdefault(row["doc_id"], []).append(row)
    return out


def test_mixing(spark):
    rows = by_id(mixing.mix_sources(awkward(spark)))
    assert sum(map(len, rows.values())) == 12
    for row in (r for group in rows.values() for r in group):
        assert 0 <= row["taken"] <= 2 * row["size"] and row["taken"] == row["copies"] * row["size"]
        assert row["lang"] is None or isinstance(row["lang"], str)
    assert rows[4][0]["size"] == 0 and rows[5][0]["size"] == 0 and rows[5][0]["source_size"] == 0
    assert rows[8][0]["source_size"] == rows[10][0]["source_size"]
    assert mixing.mix_sources(empty(spark)).count() == 0


def test_packing(spark):
    df = awkward(spark)
    packed = best_fit_packing.pack_documents(df)
    assert {"Kept", "score", "size", "sequence_id"} <= set(packed.columns) and "text" not in packed.columns
    rows = by_id(packed)
    assert rows[4][0]["length"] == 1 and bytes(rows[4][0]["ids"]) == b"\x02\0\0\0"
    assert rows[3][0]["length"] == 1 and len(rows[6]) > 20
    assert len(rows[2]) == 2
    assert best_fit_packing.pack_documents(empty(spark)).count() == 0


def test_near_duplicates(spark):
    rows = by_id(superminhash.near_duplicates(awkward(spark)))
    assert [r["component_id"] for r in rows[2]] == [1, 1] and rows[1][0]["kept"]
    assert rows[10][0]["component_id"] == 1 and not rows[10][0]["kept"]
    for empty_id in (3, 4, 5):
        assert rows[empty_id][0]["n_shingles"] == 0 and rows[empty_id][0]["component_id"] == empty_id
    assert rows[7][0]["n_shingles"] == 1 and rows[7][0]["kept"]
    assert rows[None][0]["n_shingles"] == 1
    assert superminhash.near_duplicates(empty(spark)).count() == 0
    assert superminhash.without_near_duplicates(awkward(spark)).columns == awkward(spark).columns


def test_merkle(spark):
    rows = by_id(merkle.edit_prints(awkward(spark)))
    assert sum(map(len, rows.values())) == 12
    assert rows[1][0]["fingerprint"] == rows[2][0]["fingerprint"] != rows[10][0]["fingerprint"]
    assert rows[3][0]["fingerprint"] == rows[4][0]["fingerprint"] and rows[4][0]["n_chars"] == 0
    assert rows[4][0]["near_edited"] == 1.0 and rows[4][0]["near_next"] == 1.0
    assert merkle.edit_prints(empty(spark)).count() == 0
    one = merkle.edit_prints(awkward(spark).where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_divergence(spark):
    rows = by_id(divergence.judge(awkward(spark)))
    assert rows[4][0]["n_words"] == 0 and rows[4][0]["base_failed"] and not rows[4][0]["kept"]
    assert rows[1][0]["n_repeat_words"] == rows[1][0]["n_words"] and rows[1][0]["base_failed"]
    assert divergence.judge(empty(spark)).count() == 0
    unknown = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert all(r["nearest"] is None for r in divergence.judge(unknown).collect())


def test_licenses(spark):
    rows = by_id(license_join.scan_licenses(awkward(spark)))
    assert rows[4][0]["n_words"] == 0 and rows[4][0]["labels"] == "" and rows[4][0]["first_word"] is None
    assert rows[10][0]["n_words"] == rows[1][0]["n_words"]
    assert license_join.scan_licenses(empty(spark)).count() == 0


def test_languages(spark):
    rows = by_id(crf_language.predict_languages(awkward(spark)))
    assert rows[4][0]["lang_pred"] == rows[3][0]["lang_pred"] == rows[5][0]["lang_pred"] == "und"
    assert rows[4][0]["score"] == 0.0 and 0 < rows[1][0]["score"] <= 1
    assert crf_language.predict_languages(empty(spark)).count() == 0
    unknown = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in crf_language.predict_languages(unknown).collect()} == {"und"}


def test_toxicity(spark):
    rows = by_id(toxicity.score_texts(awkward(spark), labels(spark)))
    assert rows[4][0]["score"] == 0.0 and rows[3][0]["predicted"] == 0 and len(rows[2]) == 2
    assert toxicity.score_texts(empty(spark), labels(spark)).count() == 0
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in toxicity.score_texts(awkward(spark), none).collect()} == {0.0}


@pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
def test_pipeline_stages_on_awkward_rows(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "packing":
            assert out.columns == docs.columns
        assert stage(spark, empty(spark), SF_DIR).count() == 0
    assert stage(spark, docs, SF_DIR).count() > 12
