import hashlib
import json

import pytest
from pyarrow import fs

from almanac.operators.file_quality import check_files, write_reports
from almanac.sinks import objects
from almanac.sinks import tables as sink
from almanac.sources.csv import read_csv_cells, read_csv_defensive, widest_record


@pytest.mark.parametrize(
    "path, want",
    [
        ("s3a://bucket/raw/a b%20#1.csv", ("s3", "bucket", "bucket/raw/a b%20#1.csv")),
        ("s3://bucket/k", ("s3", "bucket", "bucket/k")),
        ("file:/tmp/a b", ("file", "", "/tmp/a b")),
        ("file:///tmp/50%", ("file", "", "/tmp/50%")),
        ("/tmp/a:b#c", ("file", "", "/tmp/a:b#c")),
        ("hdfs://node:8020/a/b", ("hdfs", "node:8020", "/a/b")),
    ],
)
def test_addresses(path, want):
    assert objects.address(path) == want


def test_unknown_store():
    with pytest.raises(ValueError, match="no store known"):
        objects.address("ftp://host/file")


def test_hashes_of_files_with_odd_names(spark, tmp_path):
    folder = tmp_path / "raw files"
    folder.mkdir()
    content = {"a b.csv": b"x" * 3_000_000, "50%.csv": b"0", "c#d.csv": b"1", "e%20f.csv": b"2", "g+h.csv": b"3"}
    for name, data in content.items():
        (folder / name).write_bytes(data)
    got = {r.path.rsplit("/", 1)[1]: r.sha256 for r in sink.file_hashes(spark, str(folder)).collect()}
    assert got == {name: hashlib.sha256(data).hexdigest() for name, data in content.items()}


def test_objects_are_whole_and_replaced(spark, tmp_path):
    rows = [(f"k/{i % 3}.txt", i, f"line {i}") for i in range(3000)] + [(None, 1, "lost"), ("e.txt", 0, None)]
    df = spark.createDataFrame(rows, "name string, at int, text string").repartition(7)
    out = str(tmp_path / "out")
    for _ in range(2):
        objects.write_objects(df, "name", ["at"], "text", out)
    found = {str(p.relative_to(out)): p.read_text() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    want = {f"k/{k}.txt": "".join(f"line {i}\n" for i in range(k, 3000, 3)) for k in range(3)} | {"e.txt": "\n"}
    assert found == want


def test_failed_writes_leave_nothing(tmp_path):
    writer = objects.ObjectWriter({"path": str(tmp_path / "out")}, objects.StructType.fromDDL("key string, line string"))
    writer.write(iter([("a.txt", "1"), ("b.txt", "2")]))
    kept = writer.write(iter([("a.txt", "1"), ("a.txt", "2")]))
    writer.commit([kept, None])
    # the first task's objects were never committed
    assert [p.name for p in (tmp_path / "out").rglob("*") if p.is_file()] == ["a.txt"]
    assert (tmp_path / "out" / "a.txt").read_text() == "1\n2\n"
    other = objects.ObjectWriter({"path": str(tmp_path / "none")}, objects.StructType.fromDDL("key string, line string"))
    other.write(iter([("a.txt", "1")]))
    other.abort([])
    assert fs.LocalFileSystem().get_file_info(fs.FileSelector(str(tmp_path / "none"))) == []


def test_reports_are_single_documents(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    (source / "sub dir").mkdir(parents=True)
    (source / "sub dir" / "a b.csv").write_text("id,name,age\n1,,200\n,y,1\n")
    (source / "good.csv").write_text("id,name\n1,x\n")
    write_reports(check_files(read_csv_cells(spark, [str(source), str(source / "sub dir")])), str(source), str(out))
    reports = {str(p.relative_to(out)): json.loads(p.read_text()) for p in out.rglob("*") if p.is_file()}
    assert set(reports) == {"reports/sub dir/a b.csv.qc.json", "reports/good.csv.qc.json"}
    assert reports["reports/sub dir/a b.csv.qc.json"]["total_issues"] == 3
    assert set(reports["reports/sub dir/a b.csv.qc.json"]["row_issues"]) == {"0", "1"}


def test_records_over_several_lines(spark, tmp_path):
    text = 'a,"b\nc",d\n1,"2\n3, ""x"", 4",5\n6\n7,"8,,,,8",9\n'
    (tmp_path / "t.csv").write_text(text)
    assert widest_record(spark, str(tmp_path)) == 3
    rows = read_csv_cells(spark, str(tmp_path), multiline=True).orderBy("seq").collect()
    assert [r.cells for r in rows] == [["a", "b\nc", "d"], ["1", '2\n3, "x", 4', "5"], ["6"], ["7", "8,,,,8", "9"]]
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "t.csv").write_text("only\ncell\n")
    assert widest_record(spark, str(tmp_path / "one")) == 1
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "t.csv").write_text("")
    assert widest_record(spark, str(tmp_path / "none")) == 1


def test_files_follow_each_other_by_name(spark, tmp_path):
    # the scan takes large files first, so the order of names has to be kept by the place
    for name, rows in (("a.csv", 2), ("b.csv", 400), ("c.csv", 30)):
        (tmp_path / name).write_text("k\n" + "".join(f"{name}{i:04d}\n" for i in range(rows)))
    got = [r.k for r in read_csv_defensive(spark, str(tmp_path)).orderBy("_line_no").collect()]
    assert got == sorted(got) and len(got) == 432
