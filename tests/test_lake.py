import datetime as dt
import json
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from almanac.functions.countries import default_countries
from almanac.plans.jobs import clean_documents, retail_job
from almanac.sinks import tables as sink
from almanac.sources import lake
from almanac.sources.documents import new_documents, read_documents
from almanac.streaming import clean_zone, file_checks, occupancy


def gho(*rows):
    return json.dumps(
        {"value": [{"SpatialDim": c, "TimeDim": y, "NumericValue": v, "IndicatorCode": "X"} for c, y, v in rows]}
    )


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "raw"
    for name in ("cholera", "life_expectancy", "wb_hospital_beds_per_1000", "other"):
        (folder / name).mkdir(parents=True)
    (folder / "cholera" / "20250101T000000Z-a1.json").write_text(gho(("NGA", 2000, 1.0), ("NGA", 2001, 2.0)))
    (folder / "cholera" / "20250102T000000Z-a2.json").write_text(gho(("GHA", 2001, 3.0)))
    (folder / "cholera" / "20250103T000000Z-a3.json").write_text("{broken")
    (folder / "life_expectancy" / "20250101T000000Z-b1.json").write_text('{"value": []}')
    bank = [{"page": 1}, [{"countryiso3code": "NGA", "date": "1999", "value": 0.5, "indicator": {"id": "B"}},
                          {"countryiso3code": "NGA", "date": "2001", "value": 0.7, "indicator": {"id": "B"}}]]
    (folder / "wb_hospital_beds_per_1000" / "20250101T000000Z-c1.json").write_text(json.dumps(bank))
    (folder / "other" / "20250101T000000Z-d1.json").write_text("{}")
    return folder


def stored(spark, base, dataset="cholera"):
    return sorted((r.country_code, r.year, r.value) for r in lake.read_clean(spark, base, dataset).collect())


def test_clean_documents_is_idempotent_and_replaces_years(spark, landing, tmp_path):
    base, countries = str(tmp_path / "clean"), default_countries(spark)

    def run(day):
        return clean_documents(read_documents(spark, str(landing)), countries, base, dt.datetime(2025, 2, day))

    assert run(1) == {"processed": 4, "unreadable": 1, "bad_records": 0}
    # the newer document holds all of 2001
    assert stored(spark, base) == [("GHA", 2001, 3.0), ("NGA", 2000, 1.0)]
    manifest = {r.raw_key.split("/")[-1][:18]: (r.rows, r.written_partitions) for r in sink.read_manifest(spark, f"{base}/_manifest").collect()}
    assert manifest["20250101T000000Z-a"] == (2, 2) and manifest["20250101T000000Z-b"] == (0, 0)
    # unreadable documents are tried again, the others are skipped
    assert run(2) == {"processed": 0, "unreadable": 1, "bad_records": 0}
    assert spark.read.parquet(f"{base}/_quarantine").count() == 1
    assert stored(spark, base) == [("GHA", 2001, 3.0), ("NGA", 2000, 1.0)]
    # a changed document replaces its years only, and changing it back counts as a change
    target = landing / "cholera" / "20250101T000000Z-a1.json"
    original = target.read_text()
    target.write_text(gho(("KEN", 2000, 9.0)))
    assert run(3)["processed"] == 1
    assert stored(spark, base) == [("GHA", 2001, 3.0), ("KEN", 2000, 9.0)]
    target.write_text(original)
    assert run(4)["processed"] == 1
    assert stored(spark, base) == [("NGA", 2000, 1.0), ("NGA", 2001, 2.0)]


def test_views_tables_and_visible_years(spark, landing, tmp_path):
    base = str(tmp_path / "clean")
    clean_documents(read_documents(spark, str(landing)), default_countries(spark), base)
    views = lake.register_views(spark, base)
    assert {"cholera", "wb_hospital_beds_per_1000", "who_indicators", "worldbank_indicators"} <= set(views)
    assert spark.table("worldbank_indicators").count() == 1  # 1999 is outside the visible years
    assert spark.table("who_indicators").count() == 2
    made = lake.create_tables(spark, "health_test", base)
    assert "cholera" in made
    assert spark.table("health_test.wb_hospital_beds_per_1000").where("year = 1999").count() == 1
    spark.sql("DROP DATABASE health_test CASCADE")
    with pytest.raises(FileNotFoundError):
        lake.register_views(spark, str(tmp_path / "nothing"))
    with pytest.raises(FileNotFoundError):
        lake.read_clean(spark, str(tmp_path / "nothing"), "cholera")


def test_clean_stream_equals_batch_and_runs_consumers(spark, landing, tmp_path):
    seen = []
    base, offsets = str(tmp_path / "streamed"), str(tmp_path / "offsets")

    def run():
        clean_zone.clean_arrivals(
            spark, str(landing), base, offsets, default_countries(spark),
            [lambda s, b: seen.append(("analytics", b)), lambda s, b: seen.append(("dashboard", b))],
        ).awaitTermination()

    run()
    assert stored(spark, base) == [("GHA", 2001, 3.0), ("NGA", 2000, 1.0)]
    assert [s[0] for s in seen] == ["analytics", "dashboard"]
    run()
    assert len(seen) == 2
    (landing / "cholera" / "20250105T000000Z-a9.json").write_text(gho(("SEN", 2000, 4.0)))
    run()
    assert stored(spark, base) == [("GHA", 2001, 3.0), ("SEN", 2000, 4.0)]


def test_file_check_stream(spark, tmp_path):
    source, out, offsets = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "offsets")
    source.mkdir()
    (source / "a.csv").write_text("id,name,age\n1,x,200\n")
    (source / "skip.txt").write_text("id\n")
    run = lambda: file_checks.check_arrivals(spark, str(source), out, offsets).awaitTermination()
    run()
    (source / "b.csv").write_text("id,name\n1,\n2,y\n")
    run()
    run()
    files = {r.file.split("/")[-1]: r.total_issues for r in spark.read.parquet(f"{out}/files").collect()}
    assert files == {"a.csv": 1, "b.csv": 3}
    reports = {p.name: json.loads(p.read_text()) for p in (tmp_path / "out" / "reports").iterdir()}
    assert set(reports) == {"a.csv.qc.json", "b.csv.qc.json"} and reports["b.csv.qc.json"]["total_issues"] == 3
    assert not list((tmp_path / "out").glob("_temporary*"))


def test_occupancy_over_several_batches(spark, tmp_path):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for v in range(60):
        at = start + dt.timedelta(minutes=20 * v)
        for kind in ("arrive", "admit", "discharge")[: rng.randint(1, 3)]:
            rows.append((f"e{len(rows)}", f"v{v}", f"w{v % 3}", kind, at))
            at += dt.timedelta(minutes=rng.randint(1, 200))
    rows.sort(key=lambda r: r[4])
    schema = "event_id string, visit_id string, ward string, kind string, ts timestamp"
    df = spark.createDataFrame(rows, schema)
    source = str(tmp_path / "events")
    half = len(rows) // 2
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    for part in (rows[:half], rows[half:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(schema).parquet(source)
        runs = occupancy.start_occupancy(spark, events, out, offsets)
        for run in runs:
            run.awaitTermination()
    late = occupancy.late_events(runs[1])
    assert late == 0
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert same(occupancy.current_wards(spark, out), occupancy.ward_counts(df))
    assert same(occupancy.current_waits(spark, out), occupancy.waits(occupancy.visit_times(df)))
    assert spark.read.parquet(f"{out}/archive").count() == len(rows)


def test_repeated_late_and_nameless_events(spark, tmp_path):
    at = lambda minute: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
    schema = "event_id string, visit_id string, ward string, kind string, ts timestamp"
    batches = [
        [("a", "v1", "w", "arrive", at(0)), ("a", "v1", "w", "arrive", at(0)), (None, "v1", "w", "admit", at(7)),
         (None, "v1", "w", "admit", at(7)), ("c", "v2", "w", "admit", at(600)), (None, None, None, None, at(600))],
        # the mark stands at 590: two late rows of one event, one that is not
        [("d", "v1", "w", "discharge", at(5)), ("d", "v1", "w", "discharge", at(5)), ("e", "v2", "w", "arrive", at(595))],
        # the state of v1 has ended by now
        [("f", "v3", "w", "arrive", at(3000))],
    ]
    source, out, offsets = (str(tmp_path / n) for n in ("events", "out", "offsets"))
    late = []
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        runs = occupancy.start_occupancy(spark, spark.readStream.schema(schema).parquet(source), out, offsets)
        runs[1].awaitTermination()
        late.append(occupancy.late_events(runs[1]))
    assert late == [0, 2, 0]
    wards = {r.ward: (r.arrivals, r.admissions, r.discharges) for r in occupancy.current_wards(spark, out).collect()}
    assert wards == {"w": (3, 2, 0), None: (0, 0, 0)}
    assert sorted(tuple(r) for r in occupancy.current_waits(spark, out).collect()) == [("v1", "w", 420), ("v2", "w", 300)]
    visits = spark.read.parquet(f"{out}/visits")
    assert [tuple(r) for r in occupancy.admitted_first(visits).collect()] == [] and visits.where("visit_id = 'v2'").count() >= 2
    assert {r.visit_id for r in visits.where("closed").collect()} >= {"v1", "v2"}
    assert spark.read.parquet(f"{out}/archive").count() == 10


def test_late_events_of_many_batches():
    counter = occupancy.LateCounter()
    for n in range(250):
        operators = [SimpleNamespace(numRowsDroppedByWatermark=n % 3), SimpleNamespace(numRowsDroppedByWatermark=1)]
        counter.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(runId="r", stateOperators=operators)))
    with pytest.raises(TimeoutError):
        counter.total("r", seconds=0.01)
    counter.onQueryTerminated(SimpleNamespace(runId="r"))
    assert counter.total("r") == 250 + sum(n % 3 for n in range(250))


def test_retail_job(spark, tmp_path):
    raw, out = tmp_path / "retail.csv", str(tmp_path / "out")
    lines = ["InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"]
    for i in range(40):
        lines.append(f"{'C' if i % 9 == 0 else ''}{500 + i // 3},{22000 + i % 5},café {i % 5},{i % 7},{1 + i % 3}/{13 + i % 9}/2011 9:02,1.5,{12000 + i % 6},UK")
    raw.write_text("\n".join(lines) + "\n", encoding="latin1")
    written = retail_job(spark, str(raw), out, at=dt.datetime(2025, 1, 1))
    assert set(written) == {"sample_kpis", "daily_kpis", "top_products", "rfm"}
    meta = lake.read_metadata(spark, [str(tmp_path / "no"), out])
    assert meta["rows"]["products"] == 5 and len(spark.read.parquet(meta["input_raw_file_hash"]["table"]).first().sha256) == 64
    daily = lake.read_first(spark, [str(tmp_path / "no"), out], "daily_kpis.parquet")
    assert {"year_str", "month_str", "year"} <= set(daily.columns)
    assert daily.agg(F.sum("tx_all")).first()[0] == 40
    products = lake.read_first(spark, [out], "top_products_summary.csv")
    assert "café 1" in {r.description for r in products.collect()}
    assert lake.read_first(spark, [out], "absent.parquet").count() == 0
    assert lake.read_metadata(spark, [str(tmp_path / "no")]) == {}
    with pytest.raises(ValueError, match="unknown steps"):
        retail_job(spark, str(raw), out, ["weekly"])
    assert set(retail_job(spark, str(raw), out, ["daily"])) == {"daily_kpis"}
    with pytest.raises(Exception):
        retail_job(spark, str(tmp_path / "none.csv"), out)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", dt.datetime(2020, 1, 2, 3, 4, 5))], "k string, t timestamp_ntz")
    metrics = sink.export_result(df, str(tmp_path), "q")
    assert metrics["rows"] == 1 and len(metrics["outputs"]) == 2
    assert spark.read.text(str(tmp_path / "q.csv")).collect()[1][0] == "a,2020-01-02 03:04:05"
    sink.write_query_metrics(spark, [metrics], str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first().query == "q"
    sink.append_run_log(spark, str(tmp_path / "log"), "job", "skipped", 0)
    assert spark.read.parquet(str(tmp_path / "log")).first().outcome == "skipped"
    files = spark.read.text(str(tmp_path / "q.csv"))
    stamped = sink.with_source(files, dt.datetime(2025, 1, 1)).first()
    assert stamped.source_file.endswith(".csv") and stamped.ingested_at.year == 2025


def test_new_documents_without_manifest(spark):
    df = spark.createDataFrame([("k", "h")], "raw_key string, hash string")
    assert new_documents(df, None).count() == 1
    old = spark.createDataFrame([("k", "h", dt.datetime(2020, 1, 1)), ("k", "g", dt.datetime(2021, 1, 1))],
                                "raw_key string, hash string, processed_at timestamp")
    assert new_documents(df, old).count() == 1
