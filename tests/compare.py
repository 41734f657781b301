"""Run registered queries beside their oracle SQL: python -m tests.compare [sf] [name ...]"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.environ.get("ALMANAC_TESTDATA", "/root/testdata")


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=repr
    )


SPARK_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE",
}


def differences(spark, con, fn, sql, sf_dir) -> list[str]:
    df = fn(spark, sf_dir)
    got_columns, got = normal(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    want_columns, want = normal([d[0] for d in cursor.description], cursor.fetchall())
    problems = []
    if got_columns != want_columns:
        return [f"columns {got_columns} != {want_columns}"]
    for field in df.schema.fields:
        mine = SPARK_TYPES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if mine != types[field.name]:
            problems.append(f"type of {field.name}: {mine} != {types[field.name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {bad[0][0]} != {bad[0][1]}")
    return problems


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from almanac.session import build_session

    sf = argv[0] if argv else "0.01"
    sf_dir = f"{ROOT}/sf{sf}"
    spark = build_session(
        "compare", "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.log.level": "ERROR"},
    )
    con = oracle_connection(sf_dir)
    oracle = entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.perf_counter()
        try:
            if name in oracle:
                problems = differences(spark, con, fn, oracle[name], sf_dir)
            else:
                problems = [] if fn(spark, sf_dir).count() >= 0 else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        mark = "FAIL" if problems else ("ok" if name in oracle else "rows")
        print(f"{mark:5}{name:36}{time.perf_counter() - start:7.2f}s  {'; '.join(problems)}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
