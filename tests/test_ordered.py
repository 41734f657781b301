import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanac.operators.ordered import (
    exact_quantiles, with_previous, with_row_number, with_running_total,
)


@pytest.mark.parametrize("n", [0, 1, 7, 200])
def test_positions_totals_and_previous(spark, n):
    rng = random.Random(n)
    rows = [(rng.randint(0, 20), i) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "v int, id int")
    order = [F.col("v"), F.col("id")]
    expected = sorted(rows)
    numbered = {(r.v, r.id): r.p for r in with_row_number(df, order, "p").collect()}
    assert numbered == {row: i + 1 for i, row in enumerate(expected)}
    total, totals = 0, {}
    for row in expected:
        total += row[0]
        totals[row] = total
    found = {(r.v, r.id): r.t for r in with_running_total(df, order, "v", "t").collect()}
    assert found == totals
    before = {(r.v, r.id): r.b for r in with_previous(df, order, "id", "b").collect()}
    assert before == {
        row: (expected[i - 1][1] if i else None) for i, row in enumerate(expected)
    }


def test_quantiles_match_numpy_with_a_hot_value_and_nulls(spark):
    rng = random.Random(1)
    a = [3.0] * 60 + [rng.uniform(0, 10) for _ in range(97)] + [None] * 5
    b = [float(rng.randint(0, 5)) for _ in range(len(a))]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    points = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = {(r.column, r.point): r.value for r in exact_quantiles(df, ["a", "b"], points).collect()}
    for name, values in (("a", [x for x in a if x is not None]), ("b", b)):
        for p in points:
            assert found[(name, p)] == pytest.approx(np.quantile(values, p))
