"""What the operators hold in their Python workers."""

import tracemalloc

import pyarrow as pa
import tiktoken

from almanac.llm import best_fit_packing, common, superminhash


def test_a_worker_builds_the_vocabulary_once(monkeypatch):
    built = []
    monkeypatch.setattr(tiktoken, "Encoding", lambda *a, real=tiktoken.Encoding, **k: built.append(1) or real(*a, **k))
    one, two = (best_fit_packing.Encoder(best_fit_packing.vocabulary_path(), added=x) for x in (True, False))
    assert len(built) <= 1 and one("some words") == two("some words")


def test_the_packing_plan_starts_no_python_worker(spark):
    pieces = spark.createDataFrame(
        [(1, 3, 0, 0), (2, 3, 0, 1), (3, 5, 1, 0)], "doc_id int, length int, _task int, _rank bigint"
    ).localCheckpoint()
    packed = best_fit_packing.pack(pieces, 8)
    # rows given as a list are an RDD that Python workers unpickle
    plan = packed.drop("doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation [_length" in plan
    assert sorted((r["doc_id"], r["length"]) for r in packed.collect()) == [(1, 3), (2, 3), (3, 5)]
    assert best_fit_packing.pack(pieces.where("length > 9"), 8).collect() == []


def test_signatures_of_short_texts_take_bounded_memory():
    texts = pa.array([" ".join(f"{i} {j}" for j in range(60)) for i in range(3000)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000), pa.int64()), texts], ["doc_id", "text"])
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in superminhash._prints(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 3000 and most < 60e6


def test_near_duplicates_keep_small_frames_in_few_files(spark, tmp_path, monkeypatch):
    # a file of a local file system costs an executor four short processes, which look as large as itself for a moment
    kept = []
    monkeypatch.setattr(
        common, "staging_path", lambda spark, name: kept.append(tmp_path / f"{len(kept)}-{name}") or str(kept[-1])
    )
    texts = [" ".join(f"w{i // 4}x{j}" for j in range(40)) + f" end{i}" * (i % 4) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        rows = superminhash.near_duplicates(docs).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: i - i % 4 for i in range(400)}
    files = {path.name: len(list(path.glob("part-*"))) for path in kept}
    most = {name: n for name, n in files.items() if not name.endswith(("-forest", "-labels"))}
    assert len(most) >= 6 and max(most.values()) <= 2, files
