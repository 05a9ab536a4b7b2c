import datetime as dt
import random

import numpy as np
import pytest

from fundlake.operators.correlation import correlations

DAY = dt.date(2021, 1, 1)


def table(spark, matrix, holes=()):
    rows = [(c, DAY + dt.timedelta(days=d), None if (c, d) in holes else float(v)) for c, column in matrix.items() for d, v in enumerate(column)]
    return spark.createDataFrame(rows, "code BIGINT, date DATE, r DOUBLE")


@pytest.mark.parametrize("block", [1, 3, 8, 64])
def test_all_pairs_over_full_days(spark, block):
    rng = np.random.default_rng(1)
    base = rng.normal(size=40)
    matrix = {10 * c: 1e6 + base * rng.normal() + rng.normal(size=40) * 0.1 for c in range(11)}
    holes = {(30, 4), (0, 9), (0, 39)}
    got = {(r.code_a, r.code_b): r for r in correlations(table(spark, matrix, holes), "code", "r", block=block).collect()}
    kept = [d for d in range(40) if d not in (4, 9, 39)]
    want = np.corrcoef(np.array([column[kept] for column in matrix.values()]))
    assert set(got) == {(a, b) for a in matrix for b in matrix if a <= b}
    for (a, b), row in got.items():
        assert row.days == 37 and row.correlation == pytest.approx(want[a // 10, b // 10], abs=1e-9)


def test_constant_series_single_days_and_no_common_day(spark):
    flat = table(spark, {1: [2, 2, 2], 2: [1, 2, 3]})
    assert {(r.code_a, r.code_b): r.correlation for r in correlations(flat, "code", "r").collect()} == {(1, 1): None, (1, 2): None, (2, 2): pytest.approx(1.0)}
    assert [r.correlation for r in correlations(table(spark, {1: [2], 2: [3]}), "code", "r").collect()] == [None] * 3
    assert correlations(table(spark, {1: [1, 2], 2: [3, 4]}, {(1, 0), (2, 1)}), "code", "r").count() == 0
    assert correlations(flat.limit(0), "code", "r").count() == 0


def test_plan_size_does_not_grow_with_the_series(spark):
    rng = random.Random(2)
    sizes = []
    for k in (4, 90):
        df = correlations(table(spark, {c: [rng.random() for _ in range(5)] for c in range(k)}), "code", "r", block=4)
        sizes.append(len(df._jdf.queryExecution().optimizedPlan().toString().splitlines()))
    assert sizes[0] == sizes[1]
