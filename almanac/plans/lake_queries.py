"""Registered queries over files, documents, streams and the smaller jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from almanac.functions.hashing import sha256
from almanac.operators import documents as docs
from almanac.operators import file_quality as fq
from almanac.operators import quality, retail, side_jobs
from almanac.operators.shape import clean_numeric, ensure_date
from almanac.plans import derived, jobs
from almanac.plans.jobs import clean_documents
from almanac.plans.views import places, retail_lines, table
from almanac.session import staging_path
from almanac.sinks import tables as sink
from almanac.sources import documents as raw
from almanac.sources import lake
from almanac.sources.csv import read_csv, read_csv_cells
from almanac.streaming import clean_zone, file_checks, occupancy

QUERIES = {}
TYPED_RULES = [
    quality.Rule("c_custkey", "int", required=True),
    quality.Rule("c_name", "str", required=True),
    quality.Rule("c_acctbal", "int", min=0, max=9000),
    quality.Rule("c_phone", "str", required=True),
]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---- quality ---------------------------------------------------------------------------


@query
def row_issues(spark, sf_dir):
    return quality.row_issues(derived.people(spark, sf_dir), "c_custkey")


@query
def typed_row_issues(spark, sf_dir):
    return quality.row_issues(table(spark, sf_dir, "customer"), "c_custkey", TYPED_RULES)


@query
def total_issues(spark, sf_dir):
    return quality.total_issues(derived.people(spark, sf_dir))


@query
def issue_counts(spark, sf_dir):
    return quality.issue_counts(derived.people(spark, sf_dir))


@query
def unique_key_issues(spark, sf_dir):
    rules = [quality.Rule("l_orderkey", "int", required=True, unique=True)]
    return quality.issue_counts(table(spark, sf_dir, "lineitem"), rules)


@query
def prototype_issues(spark, sf_dir):
    checked = quality.prototype_issues(derived.people(spark, sf_dir))
    issues = checked.select("c_custkey", F.posexplode("issues").alias("place", "i"))
    return issues.select("c_custkey", "place", "i.column", "i.issue", "i.value")


@query
def column_profile(spark, sf_dir):
    return quality.column_profile(derived.people(spark, sf_dir))


@query
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def _folder(column="file"):
    return F.element_at(F.split(column, "/"), -2).alias("folder")


def _checked(spark, sf_dir):
    path = derived.write_sheets(spark, sf_dir, staging_path(spark, "sheets"))
    return fq.check_files(read_csv_cells(spark, [f"{path}/{d}" for d in ("people", "suppliers", "parts")]))


@query
def file_reports(spark, sf_dir):
    files = _checked(spark, sf_dir).files
    return files.groupBy(_folder()).agg(
        F.sum("num_rows").alias("num_rows"),
        F.max("num_columns").alias("num_columns"),
        F.max(F.array_join("columns_present", ",")).alias("columns_present"),
        F.max(F.array_join("missing_required_columns", ",")).alias("missing_required_columns"),
        F.sum("total_issues").alias("total_issues"),
    )


@query
def file_issue_counts(spark, sf_dir):
    issues = _checked(spark, sf_dir).issues.select(_folder(), F.explode("issues").alias("i"))
    return issues.groupBy("folder", "i.column", "i.issue", "i.value").agg(F.count(F.lit(1)).alias("n"))


@query
def file_column_types(spark, sf_dir):
    columns = _checked(spark, sf_dir).columns.select(_folder(), "name", "dtype", "non_null_count")
    return columns.groupBy("folder", "name", "dtype").agg(F.sum("non_null_count").alias("non_null"))


@query
def file_qc_stream(spark, sf_dir):
    path = derived.write_sheets(spark, sf_dir, staging_path(spark, "arrivals"))
    out = staging_path(spark, "reports")
    file_checks.check_arrivals(spark, path, out, staging_path(spark, "offsets")).awaitTermination()
    files = spark.read.parquet(f"{out}/files")
    return files.groupBy(_folder()).agg(
        F.sum("num_rows").alias("num_rows"), F.sum("total_issues").alias("total_issues")
    )


def _written_reports(spark, sf_dir):
    path = derived.write_sheets(spark, sf_dir, staging_path(spark, "sheets"))
    checked = fq.check_files(read_csv_cells(spark, [f"{path}/{d}" for d in ("people", "suppliers", "parts")]))
    return fq.write_reports(checked, path, staging_path(spark, "report-documents"))


def _report_rows(spark, path, whole=False):
    """The lines of report documents, or each as one value, with the key and the folder from the object's name."""
    rows = spark.read.text(path, wholetext=whole, recursiveFileLookup=True)
    key = F.regexp_extract(F.col("_metadata.file_path"), r"/(reports/[^/]+/[^/]+)$", 1)
    return rows.select("value", key.alias("report_key"), F.split(key, "/")[1].alias("folder"))


@query
def file_report_documents(spark, sf_dir):
    total = F.regexp_extract("value", r'"total_issues": (\d+)}$', 1)
    tails = _report_rows(spark, _written_reports(spark, sf_dir)).where(total != "")
    return tails.groupBy("folder").agg(F.sum(total.cast("bigint")).alias("total_issues"))


@query
def report_issue_lines(spark, sf_dir):
    # one line per row with issues, as stored in the documents: "row": [issues]
    lines = _report_rows(spark, _written_reports(spark, sf_dir))
    rows = lines.where(F.col("value").rlike(r'^(, )?"\d+": \['))
    listed = F.from_json(
        F.regexp_replace("value", r'^(, )?"\d+": ', ""), "array<struct<column:string,issue:string,value:string>>"
    )
    issues = rows.select("folder", F.explode(listed).alias("i"))
    return issues.groupBy("folder", "i.column", "i.issue", "i.value").agg(F.count(F.lit(1)).alias("n"))


@query
def report_keys(spark, sf_dir):
    # the sheets of all folders have file names of their own, so the folder must be in the key
    keys = _report_rows(spark, _written_reports(spark, sf_dir)).select("report_key", "folder").distinct()
    shaped = F.col("report_key").rlike(r"^reports/[a-z]+/part-[^/]+[.]csv[.]qc[.]json$")
    return keys.groupBy("folder").agg(F.every(shaped).alias("shaped"))


@query
def report_objects(spark, sf_dir):
    """Each report is one object that reads as one JSON document."""
    shape = "num_rows bigint, total_issues bigint, row_issues map<string,array<struct<issue:string>>>"
    found = _report_rows(spark, _written_reports(spark, sf_dir), whole=True)
    parsed = found.select("folder", "report_key", F.from_json("value", shape, {"mode": "FAILFAST"}).alias("r"))
    listed = F.coalesce(F.aggregate(F.map_values("r.row_issues"), F.lit(0), lambda n, i: n + F.size(i)), F.lit(0))
    return parsed.groupBy("folder").agg(
        (F.count_distinct("report_key") == F.count(F.lit(1))).alias("one_object_each"),
        F.sum("r.num_rows").alias("num_rows"),
        F.sum("r.total_issues").alias("total_issues"),
        F.sum(listed).cast("bigint").alias("listed_issues"),
    )


@query
def file_checks_multiline(spark, sf_dir):
    path = derived.write_notes(spark, sf_dir, staging_path(spark, "notes"))
    out = staging_path(spark, "reports")
    run = file_checks.check_arrivals(spark, path, out, staging_path(spark, "offsets"), multiline=True)
    run.awaitTermination()
    return spark.read.parquet(f"{out}/files").groupBy(_folder()).agg(
        F.sum("num_rows").alias("num_rows"),
        F.max("num_columns").cast("bigint").alias("num_columns"),
        F.max(F.array_join("columns_present", "|")).alias("columns_present"),
        F.sum("total_issues").alias("total_issues"),
    )


@query
def raw_file_hashes(spark, sf_dir):
    """A table's lines as many files, whose names have blanks and signs, hashed in pieces."""
    path = derived.write_line_files(spark, sf_dir, staging_path(spark, "raw files"))
    hashes = sink.file_hashes(spark, f"{path}/*/*.txt")
    number = F.regexp_extract(F.element_at(F.split("path", "/"), -2), r"(?:%23|#)(\d+)$", 1).cast("bigint")
    return hashes.select(number.alias("part"), "sha256")


@query
def landed_rows(spark, sf_dir):
    """Rows taken in from files, with their provenance."""
    source, out = staging_path(spark, "sheets"), staging_path(spark, "landed")
    derived.write_sheets(spark, sf_dir, source)
    jobs.land_files(spark, f"{source}/suppliers", out, dt.datetime(2024, 5, 6, 7, 8, 9))
    from_file = F.col("source_file").rlike(r"^part-.*[.]csv$")
    return spark.read.parquet(out).select(
        F.col("s_name"), from_file.alias("from_file"), F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at")
    )


@query
def report_verdicts(spark, sf_dir):
    return fq.verdicts(derived.report_rows(spark, sf_dir))


@query
def quality_trend(spark, sf_dir):
    trend = fq.quality_trend(derived.report_rows(spark, sf_dir))
    return trend.withColumn("day", F.col("day").cast("timestamp_ntz"))


# ---- documents and the clean zone ------------------------------------------------------


@query
def gho_rows(spark, sf_dir):
    return docs.parse_gho(derived.gho_documents(spark, sf_dir), ["o_orderkey"])


@query
def world_bank_rows(spark, sf_dir):
    return docs.parse_world_bank(derived.bank_documents(spark, sf_dir), ["o_orderkey"])


@query
def world_bank_labelled(spark, sf_dir):
    return docs.parse_world_bank(
        derived.bank_documents(spark, sf_dir), ["o_orderkey"], labels=True, drop_null=True
    )


@query
def unreadable_years(spark, sf_dir):
    found = docs.unreadable_years(derived.bank_documents(spark, sf_dir), ["o_orderkey"])
    return found.select("o_orderkey", F.get_json_object("record", "$.date").alias("date"))


@query
def clean_zone_quarantine(spark, sf_dir):
    """World Bank records with a bad year, as kept by the job that cleans their documents."""
    name = "wb_hospital_beds_per_1000"
    key = F.col("o_orderkey").cast("string")
    documents = derived.bank_documents(spark, sf_dir).select(
        F.concat(F.lit(f"raw/{name}/"), key, F.lit(".json")).alias("raw_key"), sha256(F.col("body")).alias("hash"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("landed_at"), "body", F.lit(name).alias("dataset"),
    )
    base = staging_path(spark, "clean")
    clean_documents(documents, places(spark, sf_dir), base)
    kept = spark.read.parquet(f"{base}/_quarantine_records")
    return kept.select(
        F.regexp_extract("raw_key", r"(\d+)[.]json$", 1).cast("bigint").alias("o_orderkey"),
        F.get_json_object("record", "$.date").alias("date"),
    )


@query
def notice_dates(spark, sf_dir):
    """Every notice, as a row with its date or for quarantine with the reason."""
    records = docs.notice_records(derived.dated_notices(spark, sf_dir), ["o_orderkey"])
    good = docs.outbreak_rows(records, places(spark, sf_dir), ["o_orderkey"]).select(
        "o_orderkey", F.col("publication_date").cast("timestamp_ntz").alias("publication_date"), F.lit(None).cast("string").alias("reason")
    )
    bad = docs.undated_notices(records, ["o_orderkey"]).select(
        "o_orderkey", F.lit(None).cast("timestamp_ntz").alias("publication_date"), "reason"
    )
    return good.unionByName(bad)


@query
def undated_notice_records(spark, sf_dir):
    """Notices without a readable date, as kept by the job that cleans their documents."""
    key = F.col("o_orderkey").cast("string")
    documents = derived.dated_notices(spark, sf_dir).select(
        F.concat(F.lit("raw/who_outbreaks/"), key, F.lit(".json")).alias("raw_key"), sha256(F.col("body")).alias("hash"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("landed_at"), "body", F.lit("who_outbreaks").alias("dataset"),
    )
    base = staging_path(spark, "clean")
    outcome = clean_documents(documents, places(spark, sf_dir), base)
    kept = spark.read.parquet(f"{base}/_quarantine_records")
    return kept.groupBy("reason").agg(
        F.count(F.lit(1)).alias("records"), F.lit(outcome["bad_records"]).cast("bigint").alias("all_bad"),
        F.lit(outcome["processed"]).cast("bigint").alias("documents"),
    )


@query
def outbreak_rows(spark, sf_dir):
    rows = docs.parse_outbreaks(
        derived.notice_documents(spark, sf_dir), places(spark, sf_dir), ["o_orderkey"]
    )
    return rows.withColumn("publication_date", F.col("publication_date").cast("timestamp_ntz"))


@query
def notice_export(spark, sf_dir):
    rows = docs.normalise_notices(derived.notice_documents(spark, sf_dir))
    path = sink.write_csv(rows.select(*sink.NOTICE_EXPORT), staging_path(spark, "notices"))
    return read_csv(spark, path)


@query
def routed_keys(spark, sf_dir):
    keys = derived.raw_keys(spark, sf_dir)
    key = raw.landing_key(F.col("name"), F.col("at"), F.col("content"), F.col("kind"))
    return keys.select("o_orderkey", key.alias("raw_key")).select(
        "o_orderkey",
        "raw_key",
        raw.dataset_of(F.col("raw_key")).alias("dataset"),
        raw.landed_at(F.col("raw_key")).cast("timestamp_ntz").alias("landed_at"),
        raw.landing_id(F.col("raw_key")).alias("landing_id"),
    )


@query
def content_hashes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", sha256(F.col("text")).alias("sha256"))


@query
def new_documents(spark, sf_dir):
    """Documents that are new or changed against a manifest of the labelled ones."""
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("raw_key"), sha256(F.col("text")).alias("hash")
    )
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("raw_key"), "quality"
    )
    seen = documents.join(labels, "raw_key").select(
        "raw_key",
        F.when(F.col("quality") == 1, F.col("hash")).otherwise("changed").alias("hash"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("processed_at"),
    )
    return raw.new_documents(documents, seen)


def _clean_zone(spark, sf_dir):
    source = derived.write_documents(spark, sf_dir, staging_path(spark, "landing"))
    base = staging_path(spark, "clean")
    run = clean_zone.clean_arrivals(
        spark, source, base, staging_path(spark, "offsets"), places(spark, sf_dir), glob="*.txt"
    )
    run.awaitTermination()
    return base


@query
def clean_zone_stream(spark, sf_dir):
    clean = lake.read_clean(spark, _clean_zone(spark, sf_dir), derived.DATASET)
    return clean.select("country_code", "indicator_code", "value", "year")


@query
def clean_zone_manifest(spark, sf_dir):
    manifest = sink.read_manifest(spark, f"{_clean_zone(spark, sf_dir)}/_manifest")
    landed = raw.landed_at(F.col("raw_key")).cast("timestamp_ntz")
    return manifest.select(landed.alias("landed_at"), "rows", "written_partitions")


@query
def clean_zone_sql(spark, sf_dir):
    lake.register_views(spark, _clean_zone(spark, sf_dir))
    return spark.sql(
        "SELECT indicator_code, year, COUNT(*) AS n, MAX(value) AS highest "
        "FROM who_indicators GROUP BY indicator_code, year"
    )


@query
def year_overwrite(spark, sf_dir):
    """All years written, then 1998 replaced by a single indicator's rows."""
    rows = derived.coded_orders(spark, sf_dir).select(
        "o_orderkey", "o_orderpriority", F.col("o_totalprice").alias("value"), "year"
    )
    path = sink.replace_partitions(rows, staging_path(spark, "years"), "year")
    newer = rows.where((F.col("year") == 1998) & (F.col("o_orderpriority") == "1-URGENT"))
    sink.replace_partitions(newer, path, "year")
    stored = spark.read.parquet(path)
    return stored.groupBy("year", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query
def two_level_partitions(spark, sf_dir):
    rows = derived.coded_orders(spark, sf_dir).select(
        F.col("code").alias("country_code"), F.col("o_totalprice").alias("value"),
        F.col("o_orderstatus").alias("indicator_code"), "year",
    )
    path = sink.replace_partitions(rows, staging_path(spark, "layout"), "indicator_code", "year")
    stored = spark.read.parquet(path)
    return stored.where("indicator_code = 'F' AND year >= 2000").select(
        "country_code", "value", "indicator_code", "year"
    )


@query
def daily_partition_files(spark, sf_dir):
    daily = retail.daily_kpis(retail_lines(spark, sf_dir))
    path = sink.write_daily(daily, staging_path(spark, "daily"))
    stored = spark.read.option("partitionInferSchema", False).parquet(path)
    return stored.select(
        "date", "tx_all", "year", F.lpad(F.col("year_str").cast("string"), 4, "0").alias("year_str"),
        F.lpad(F.col("month_str").cast("string"), 2, "0").alias("month_str"),
    )


@query
def exported_result(spark, sf_dir):
    path = staging_path(spark, "export")
    counted = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    metrics = sink.export_result(counted, path, "events_by_type")
    sink.write_query_metrics(spark, [metrics], f"{path}/_query_metrics")
    return spark.read.schema("event_type string, n bigint").json(f"{path}/events_by_type.json")


@query
def chart_ready(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value").cast("string")).otherwise("n/a").alias("value"),
        F.col("ts").alias("InvoiceDate"),
    )
    return ensure_date(clean_numeric(events, ["value"])).select("event_id", "value", "date")


# ---- wards -----------------------------------------------------------------------------


def _wards(spark, sf_dir):
    events = (
        spark.readStream.schema(table(spark, sf_dir, "events").schema)
        .option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    out = staging_path(spark, "wards")
    runs = occupancy.start_occupancy(
        spark, derived.ward_events(events), out, staging_path(spark, "offsets")
    )
    for run in runs:
        run.awaitTermination()
    return out


@query
def occupancy_stream(spark, sf_dir):
    report = occupancy.ward_report(spark, _wards(spark, sf_dir))
    return report.withColumn("mean_wait_seconds", F.round("mean_wait_seconds", 4))


@query
def ward_waits(spark, sf_dir):
    return occupancy.current_waits(spark, _wards(spark, sf_dir))


@query
def ward_archive(spark, sf_dir):
    archive = spark.read.parquet(f"{_wards(spark, sf_dir)}/archive")
    return archive.groupBy("ward", "kind").agg(F.count(F.lit(1)).alias("n"))


@query
def ward_late_events(spark, sf_dir):
    """Three deliveries with repeated and late events, the runs started again after each."""
    arriving = derived.arriving_events(spark, sf_dir)
    landing, out, offsets = (staging_path(spark, n) for n in ("landing", "wards", "offsets"))
    late = 0
    for delivery in range(3):
        arriving.where(F.col("delivery") == delivery).drop("delivery").write.mode("append").parquet(landing)
        events = spark.readStream.schema(arriving.drop("delivery").schema).parquet(landing)
        runs = occupancy.start_occupancy(spark, derived.ward_events(events), out, offsets)
        runs[1].awaitTermination()
        late += occupancy.late_events(runs[1])
    return occupancy.current_wards(spark, out).withColumn("late_events", F.lit(late).cast("bigint"))


# ---- smaller jobs ----------------------------------------------------------------------


@query
def imaging_studies(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    body = F.to_json(
        F.struct(
            F.concat(F.lit("study-"), F.col("user_id").cast("string")).alias("StudyInstanceUID"),
            F.concat(F.lit("series-"), (F.col("event_id") % 40).cast("string")).alias("SeriesInstanceUID"),
            F.col("event_id").cast("string").alias("SOPInstanceUID"),
            F.upper(F.substring("event_type", 1, 2)).alias("Modality"),
            F.lit("hidden").alias("PatientName"),
        )
    )
    return side_jobs.studies(side_jobs.imaging_catalogue(events.select(body.alias("body"))), "CL")


@query
def churn_scores(spark, sf_dir):
    model = side_jobs.read_model(
        '{"intercept": -0.5, "weights": {"c_acctbal": -0.0002, "c_nationkey": 0.05}}'
    )
    scores = side_jobs.churn_scores(table(spark, sf_dir, "customer"), model, "c_custkey")
    return scores.withColumn("churn_probability", F.round("churn_probability", 10))


@query
def waste_report(spark, sf_dir):
    supplier, part = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    customer, order = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    findings = side_jobs.waste_findings(
        supplier.select(F.col("s_suppkey").alias("resource_id"), (F.col("s_acctbal") / 100).alias("cpu_percent")),
        part.select(
            F.col("p_partkey").alias("resource_id"), F.col("p_size").alias("size_gb"),
            F.when(F.col("p_size") > 10, F.col("p_brand")).alias("attached_to"),
        ),
        customer.select(
            F.col("c_custkey").alias("resource_id"),
            F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).alias("used_by"),
        ),
        order.select(F.col("o_orderkey").alias("resource_id"), F.col("o_orderdate").alias("created")),
        dt.date(2001, 8, 1),
    )
    return side_jobs.waste_report(findings)


@query
def invoice_fields(spark, sf_dir):
    order = table(spark, sf_dir, "orders")

    def field(name, value):
        return F.struct(F.lit(name).alias("key"), value.cast("string").alias("value"))

    body = F.to_json(
        F.array(
            field("Vendor", F.concat(F.lit(" Vendor "), F.col("o_custkey"))),
            field("Total ", F.concat(F.lit("EUR "), F.format_number("o_totalprice", 2))),
            field("date", F.date_format("o_orderdate", "yyyy-MM-dd")),
            field("note", F.lit("x")),
        )
    )
    rows = side_jobs.invoice_fields(order.select(F.col("o_orderkey").alias("invoice_id"), body.alias("body")))
    return rows.withColumns(
        {"total": F.col("total").cast("double"), "invoice_date": F.col("invoice_date").cast("timestamp_ntz")}
    )
