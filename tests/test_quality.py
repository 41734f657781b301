import json

import pytest
from pyspark.sql import functions as F

from almanac.operators import file_quality as fq
from almanac.operators import quality
from almanac.sources.csv import read_csv, read_csv_cells

HEAD = "id,name,age,email,signup_date"


def sheet(n, **changes):
    """n good lines; `changes` maps a column to {line: value}."""
    lines = [HEAD]
    for i in range(n):
        row = {
            "id": str(i + 1), "name": f"Alice{i + 1}", "age": str(20 + (i if i != 24 else 0)),
            "email": f"user{i + 1}@example.com", "signup_date": f"2020-01-{i % 28 + 1:02d}",
        }
        for column, values in changes.items():
            if i in values:
                row[column] = values[i]
        lines.append(",".join(row[c] for c in HEAD.split(",")))
    return "\n".join(lines) + "\n"


EVERY_FIFTH = {i: "" for i in (4, 9, 14, 19, 24)}
FLAGS = ["Yes", "No", "N/A"]


def extra_column():
    lines = sheet(25).strip().split("\n")
    return "\n".join([lines[0] + ",Extra_Field"] + [f"{x},{FLAGS[i % 3]}" for i, x in enumerate(lines[1:])]) + "\n"


FILES = {
    "bad_age_out_of_range": sheet(15, age={6: "150", 13: "-5"}),
    "bad_age_string": sheet(12, age={5: "twenty", 9: "N/A"}),
    "bad_duplicate_id": sheet(12, id={5: "5", 11: "11"}),
    "bad_extra_column": extra_column(),
    "bad_id_float": sheet(25, id={9: "14.5"}),
    "bad_invalid_date": sheet(12, signup_date={5: "06/20/2021", 10: "2021-99-99"}),
    "bad_invalid_email": sheet(10, email={3: "test.com"}),
    "bad_missing": "id,age\n1,30\n2,150\n",
    "bad_missing_email_date": sheet(25, email={i: "" for i in range(6)}, signup_date={i: "" for i in range(6)}),
    "bad_missing_id": sheet(25, id=EVERY_FIFTH),
    "bad_missing_name": sheet(25, name=EVERY_FIFTH),
    "good": sheet(2),
    "good_boundary_ages": sheet(5, age={0: "0", 1: "120"}),
    "good_clean_data": sheet(25),
    "headers_only": HEAD + "\n",
}
# file -> rows, columns, issues by row, missing required columns, some profile entries
GOLDEN = {
    "bad_age_out_of_range": (15, 5, {6: [("age", "out_of_range", 150)], 13: [("age", "out_of_range", -5)]}, [], {"age": (15, "int64")}),
    "bad_age_string": (12, 5, {5: [("age", "type_mismatch", "twenty")], 9: [("age", "missing", None)]}, [], {"age": (11, "object")}),
    "bad_duplicate_id": (12, 5, {}, [], {"id": (12, "int64")}),
    "bad_extra_column": (25, 6, {}, [], {"Extra_Field": (17, "object"), "age": (25, "int64")}),
    "bad_id_float": (25, 5, {}, [], {"id": (25, "float64")}),
    "bad_invalid_date": (12, 5, {10: [("signup_date", "invalid_date", "2021-99-99")]}, [], {}),
    "bad_invalid_email": (10, 5, {}, [], {"email": (10, "object")}),
    "bad_missing": (2, 2, {0: [("name", "missing", None)], 1: [("name", "missing", None), ("age", "out_of_range", 150)]}, ["name"], {"id": (2, "int64")}),
    "bad_missing_email_date": (25, 5, {}, [], {"email": (19, "object"), "signup_date": (19, "object")}),
    "bad_missing_id": (25, 5, {i: [("id", "missing", None)] for i in EVERY_FIFTH}, [], {"id": (20, "float64")}),
    "bad_missing_name": (25, 5, {i: [("name", "missing", None)] for i in EVERY_FIFTH}, [], {"name": (20, "object")}),
    "good": (2, 5, {}, [], {}),
    "good_boundary_ages": (5, 5, {}, [], {}),
    "good_clean_data": (25, 5, {}, [], {}),
    "headers_only": (0, 5, {}, [], {"id": (0, "object")}),
}


@pytest.fixture(scope="module")
def checked(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sheets")
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
    return fq.check_files(read_csv_cells(spark, str(folder)))


@pytest.fixture(scope="module")
def reports(checked):
    found = {}
    for row in fq.report_lines(checked).orderBy("file", "part", "row_index").collect():
        found.setdefault(row.file.split("/")[-1].removesuffix(".csv"), []).append(row.line)
    return {name: json.loads("".join(lines)) for name, lines in found.items()}


@pytest.mark.parametrize("name", sorted(FILES))
def test_report(reports, name):
    rows, columns, issues, missing, profile = GOLDEN[name]
    report = reports[name]
    assert (report["num_rows"], report["num_columns"]) == (rows, columns)
    found = {
        int(k): [(i["column"], i["issue"], i["value"]) for i in v] for k, v in report["row_issues"].items()
    }
    assert found == issues
    assert report["missing_required_columns"] == missing
    assert report["total_issues"] == sum(len(v) for v in issues.values())
    for column, (non_null, dtype) in profile.items():
        entry = report["summary"]["columns"][column]
        assert (entry["non_null_count"], entry["dtype"]) == (non_null, dtype)
    if name != "bad_missing":
        assert report["columns_present"][:5] == HEAD.split(",")


def test_report_details(reports):
    assert reports["bad_duplicate_id"]["summary"]["columns"]["id"]["unique"] == 10
    assert reports["good_clean_data"]["summary"]["columns"]["age"]["unique"] == 24
    assert reports["bad_extra_column"]["summary"]["columns"]["Extra_Field"]["unique"] == 2
    mismatch = reports["bad_age_string"]["row_issues"]["5"][0]
    assert mismatch == {"column": "age", "issue": "type_mismatch", "expected": "int", "value": "twenty"}


def test_written_reports_have_their_whole_key(spark, tmp_path):
    for folder in ("x", "y z+"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        rows = "".join(f"{i},n,200\n" for i in range(300))
        (tmp_path / "in" / folder / "data.csv").write_text("id,name,age\n" + rows)
    checked = fq.check_files(read_csv_cells(spark, [str(tmp_path / "in" / f) for f in ("x", "y z+")]))
    fq.write_reports(checked, str(tmp_path / "in"), str(tmp_path / "out"))
    reports = {str(p.relative_to(tmp_path / "out")): p for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert set(reports) == {"reports/x/data.csv.qc.json", "reports/y z+/data.csv.qc.json"}
    for path in reports.values():
        report = json.loads(path.read_text())
        assert report["total_issues"] == 300 and len(report["row_issues"]) == 300


def test_verdicts(checked):
    assert {r.status: r.files for r in fq.verdicts(checked.files).collect()} == {"pass": 9, "fail": 6}


def test_row_numbers_over_many_scan_ranges(spark, tmp_path):
    n, bad = 5000, {17, 1800, 4999}
    (tmp_path / "big.csv").write_text(sheet(n, age={i: "x" for i in bad}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        checked = fq.check_files(read_csv_cells(spark, str(tmp_path)), [quality.Rule("age", "int")])
        assert {r.row_index for r in checked.issues.collect()} == bad
        assert checked.files.first().num_rows == n
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_too_many_cells_is_an_error(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("a,b\n1,2,3,4\n")
    with pytest.raises(Exception, match="more than 2 cells"):
        read_csv_cells(spark, str(tmp_path), width=2).collect()


def test_table_rules(spark):
    df = spark.createDataFrame(
        [("1", "Al", "1_0", None), ("x", None, "14.5", "2020-02-30"), (None, "Bo", " 7 ", "Feb 3 2020")],
        "id string, name string, age string, signup_date string",
    )
    got = [[(i.column, i.issue, i.value) for i in r.issues] for r in quality.with_issues(df).collect()]
    assert got == [
        [],
        [("id", "type_mismatch", "x"), ("name", "missing", None), ("age", "type_mismatch", "14.5"),
         ("signup_date", "invalid_date", "2020-02-30")],
        [("id", "missing", None)],
    ]
    # in a column of numbers only, a fraction is cut and then compared
    numbers = spark.createDataFrame([("120.9",), ("121.0",), ("inf",), ("-0.5",)], "age string")
    rule = [quality.Rule("age", "int", min=0, max=120)]
    assert [[i.issue for i in r.issues] for r in quality.with_issues(numbers, rule).collect()] == [
        [], ["out_of_range"], ["type_mismatch"], []
    ]


def test_schema_dictionary_unique_and_missing(spark):
    rules = quality.rules_from_schema({"id": {"required": True, "type": "int", "unique": True}})
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert quality.issue_counts(df, rules).collect()[0].n == 2
    assert quality.missing_required(["id", "age"]) == ["name"]
    with pytest.raises(ValueError):
        quality.Rule("x", "float")


def test_prototype(spark):
    df = spark.createDataFrame(
        [(1, "Alice", "30"), (2, "Bob", "twenty"), (3, None, "150"), (4, "Di", None)],
        "id int, name string, age string",
    )
    got = [[(i.column, i.issue, i.value) for i in r.issues] for r in quality.prototype_issues(df).collect()]
    assert got == [
        [],
        [("age", "not_integer", "twenty")],
        [("name", "missing_required", None), ("age", "age_out_of_range", "150")],
        [("age", "missing_required", None), ("age", "not_integer", None)],
    ]


def test_na_texts_read_as_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\nN/A,"x, y"\nnull,"say ""hi"""\n')
    rows = read_csv(spark, str(tmp_path)).collect()
    assert [(r.a, r.b) for r in rows] == [(None, "x, y"), (None, 'say "hi"')]


def test_quoted_line_breaks_with_multiline(spark, tmp_path):
    (tmp_path / "m.csv").write_text('id,name,age\n1,"a\nb",3\n2,c,x\n')
    rules = [quality.Rule("age", "int")]
    checked = fq.check_files(read_csv_cells(spark, str(tmp_path), multiline=True), rules)
    assert [r.row_index for r in checked.issues.collect()] == [1]
    assert checked.files.first().num_rows == 2


def test_column_profile_types_and_empty_table(spark):
    df = spark.createDataFrame(
        [("1", "1", "true", None, "1.0"), ("2", None, "false", None, "1"), ("2", "3", "true", None, "x")],
        "a string, b string, c string, d string, e string",
    )
    got = {r.column: (r.non_null_count, r.unique, r.dtype) for r in quality.column_profile(df).collect()}
    assert got == {
        "a": (3, 2, "int64"), "b": (2, 2, "float64"), "c": (3, 2, "bool"), "d": (0, 0, "float64"),
        "e": (3, 3, "object"),
    }
    empty = {r.column: (r.non_null_count, r.dtype) for r in quality.column_profile(df.limit(0)).collect()}
    assert empty == {c: (0, "object") for c in "abcde"}


def test_headers_are_found_without_sorting_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,,age\n1,id,3\n2,x,age\n")
    (tmp_path / "b.csv").write_text("age\nid\n")
    counted = fq._count_cells(read_csv_cells(spark, str(tmp_path)))
    headers = fq._headers(counted)
    rows = [(r["file"][-5:], r["pos"], r["head"], r["name"]) for r in headers.collect()]
    assert sorted(rows, key=lambda r: r[:2]) == [
        ("a.csv", 0, "id", "id"), ("a.csv", 1, None, "Unnamed: 1"), ("a.csv", 2, "age", "age"), ("b.csv", 0, "age", "age"),
    ]
    # all cells of a file's column would meet in one task to be sorted
    assert "SortAggregate" not in headers._jdf.queryExecution().executedPlan().toString()


def test_records_of_one_file_are_dealt_out(spark, tmp_path):
    rows = "".join(f'{i},"text {i}\nmore"\n' for i in range(200))
    (tmp_path / "a.csv").write_text("id,note\n" + rows)
    lines = read_csv_cells(spark, str(tmp_path), multiline=True)
    assert lines.select(F.spark_partition_id()).distinct().count() > 1
    assert [r["cells"] for r in lines.orderBy("seq").collect()][:2] == [["id", "note"], ["0", "text 0\nmore"]]
