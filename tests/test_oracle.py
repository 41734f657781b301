"""Every registered query against its oracle SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import ROOT, differences, oracle_connection

SF_DIR = f"{ROOT}/sf{os.environ.get('ALMANAC_TEST_SF', '0.001')}"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name not in ORACLE:
        assert QUERIES[name](spark, SF_DIR).count() > 0
    else:
        assert differences(spark, con, QUERIES[name], ORACLE[name], SF_DIR) == []


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "date"
