from decimal import Decimal

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundlake.operators import aggregates, constraints, dedup, ranking, selection, reshape, series, sets
from tests.conftest import by_key


def test_keep_last_and_first_follow_arrival(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("b", 2, 20), ("a", 2, 99)], "k STRING, ingest_seq INT, v INT")
    assert {r.k: r.v for r in dedup.keep_last(df, ["k"]).collect()} == {"a": 30, "b": 20}
    assert {r.k: r.v for r in dedup.keep_first(df, ["k"]).collect()} == {"a": 10, "b": 20}


def test_dedup_limits_groups_before_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("ingest_seq"))
    plan = dedup.keep_last(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows share one value, and one group holds most rows."""
    rng = random.Random(7)
    rows = []
    for i in range(4000):
        group = "hot" if rng.random() < 0.8 else f"g{rng.randrange(5)}"
        value = 5.0 if rng.random() < 0.5 else round(rng.uniform(-50, 50), 3)
        rows.append((i, group, value if rng.random() > 0.02 else None))
    return spark.createDataFrame(rows, "id BIGINT, g STRING, v DOUBLE").repartition(4)


def test_exact_quantiles_match_linear_interpolation(skewed):
    points = {"p01": 0.01, "q1": 0.25, "median": 0.5, "p99": 0.99, "lo": 0.0, "hi": 1.0}
    local = skewed.toPandas().dropna()
    got = by_key(selection.exact_quantiles(skewed, "v", points, ["g"]), "g")
    assert set(got) == set(local.g)
    for group, values in local.groupby("g").v:
        for name, p in points.items():
            assert got[group][name] == pytest.approx(np.quantile(values, p), abs=1e-9)
    whole = selection.exact_quantiles(skewed, "v", points).first()
    assert whole.p99 == pytest.approx(np.quantile(local.v, 0.99), abs=1e-9)


def test_min_ranks_of_skewed_values(skewed):
    spec = {"down": ("v", False), "up": ("v", True)}
    spread = {r.id: (r.down, r.up) for r in ranking.min_ranks(skewed, spec).collect()}
    local = skewed.toPandas().set_index("id").v
    expected = local.rank(method="min", ascending=False)
    assert all((spread[i][0] is None) == np.isnan(expected[i]) for i in local.index)
    assert all(spread[i][0] == expected[i] for i in local.index if not np.isnan(expected[i]))


def test_row_numbers_of_skewed_values(skewed):
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    spread = {r.id: r.n for r in ranking.row_numbers(skewed, order, "n").collect()}
    local = skewed.toPandas().sort_values(["v", "id"], ascending=[False, True])
    assert spread == {i: n for n, i in enumerate(local.id, 1)}


def test_tied_ranks_skip(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0), (3, 1.0), (4, None)], "id BIGINT, v DOUBLE")
    ranks = {r.id: r.r for r in ranking.min_ranks(df, {"r": ("v", False)}).collect()}
    assert ranks == {1: 1, 2: 1, 3: 3, 4: None}


@pytest.mark.parametrize("kind,rows,expected", [
    ("DOUBLE", [(1, 3.0), (2, float("nan")), (3, 1.0), (4, None)], [(1, 1), (2, None), (3, 2), (4, None)]),
    ("BIGINT", [(1, 2**53), (2, 2**53 + 1), (3, 5)], [(1, 2), (2, 1), (3, 3)]),
    ("DOUBLE", [(1, 1.0), (1, 2.0), (2, 3.0)], [(1, 2), (1, 3), (2, 1)]),
    ("DECIMAL(30,10)", [(1, Decimal("1.0000000001")), (2, Decimal("1.0000000002")), (3, None)], [(1, 2), (2, 1), (3, None)]),
])
def test_ranks_keep_types_and_rows(spark, kind, rows, expected):
    df = spark.createDataFrame(rows, f"id BIGINT, v {kind}")
    got = ranking.min_ranks(df, {"down": ("v", False), "up": ("v", True)}).collect()
    assert sorted((r.id, r.down) for r in got if r.down is not None) == sorted(x for x in expected if x[1] is not None)
    n = sum(x[1] is not None for x in expected)
    assert all(r.up == n + 1 - r.down for r in got if r.down is not None) and len(got) == len(rows)


def test_rest_leaves_missing_labels_out(spark):
    df = spark.createDataFrame([(None, 5.0), ("a", 3.0), ("b", 1.0)], "label STRING, v DOUBLE")
    rows = {r.label: r.v for r in ranking.top_n_with_rest(df, "label", "v", 1).collect()}
    assert rows == {"a": 3.0, "Others": 1.0}


def test_pivots_refuse_keys_not_listed(spark):
    df = spark.createDataFrame([("x", "2024-01", 1.0), ("x", "2024-02", 2.0), ("x", None, 4.0)], "k STRING, m STRING, v DOUBLE")
    assert reshape.pivot_sum(df, "k", "m", "v", ["2024-01", "2024-02"]).first()["2024-02"] == 2.0
    for pivot in (reshape.pivot_sum, reshape.pivot_mean, reshape.pivot_unique):
        with pytest.raises(Exception, match="not listed"):
            pivot(df, "k", "m", "v", ["2024-01"]).count()
    with pytest.raises(Exception, match="duplicate entry"):
        reshape.pivot_unique(df.union(df), "k", "m", "v", ["2024-01", "2024-02"]).select("k").collect()


@pytest.mark.parametrize("n,names", [(9, 9), (10, 10)])
def test_others_only_beyond_the_top(spark, n, names):
    df = spark.createDataFrame([(f"s{i:02d}", float(i + 1)) for i in range(n)], "sector STRING, w DOUBLE")
    rows = ranking.top_n_with_rest(df, "sector", "w", 9).collect()
    assert len(rows) == names
    assert ("Others" in {r.sector for r in rows}) == (n > 9)
    assert sum(r.w for r in rows) == n * (n + 1) / 2


def test_calendar_fill(prices, day):
    filled = series.fill_calendar(prices({1: {"2024-01-05": 10, "2024-01-08": 11}, 2: {"2024-01-06": 7}}), "amfi_code", "date", "nav")
    rows = sorted((r.amfi_code, r.date.isoformat(), r.nav) for r in filled.collect())
    assert rows == [(1, "2024-01-05", 10.0), (1, "2024-01-06", 10.0), (1, "2024-01-07", 10.0), (1, "2024-01-08", 11.0), (2, "2024-01-06", 7.0)]


def test_fill_equals_reindex_and_forward_fill(prices):
    rng = random.Random(3)
    table = prices({k: {f"2024-{m:02d}-{d:02d}": rng.random() for m in range(1, 7) for d in range(1, 28) if rng.random() < 0.2} for k in range(5)})
    spine = series.reindex_daily(table, "amfi_code", "date").withColumn("nav", series.forward_filled("nav", "amfi_code"))
    filled = series.fill_calendar(table, "amfi_code", "date", "nav")
    assert sorted(map(tuple, filled.collect())) == sorted(map(tuple, spine.select("amfi_code", "date", "nav").collect()))


def test_two_rebasing_rules(prices):
    table = prices({1: ("2024-01-01", [50, 60]), 2: ("2024-01-02", [10, 20])})
    first_day = {(r.amfi_code, r.date.day): r.indexed for r in series.rebase_to_first_day(table, "amfi_code", "nav").collect()}
    own = {(r.amfi_code, r.date.day): r.normalized_value for r in series.rebase_to_own_start(table, "amfi_code", "nav").collect()}
    assert first_day == {(1, 1): 100.0, (1, 2): 120.0, (2, 2): None, (2, 3): None}
    assert own[(2, 2)] == 100.0 and own[(2, 3)] == 200.0


def test_as_of_and_nearest(prices, day):
    table = prices({1: {"2024-01-01": 1, "2024-01-10": 2}, 2: {"2024-02-01": 3}})
    hits = by_key(series.as_of(table, F.lit("2024-01-09").cast("date"), "amfi_code", "nav"))
    assert hits[1].nav == 1.0 and hits[2].nav is None
    near = series.nearest_to_markers(table.where("amfi_code = 1"), {"tie": "2024-01-05", "late": "2024-03-01"}, "nav", "date")
    assert {r.label: r.nav for r in near.collect()} == {"tie": 1.0, "late": 2.0}


def test_lowest_takes_the_first_of_equal_values(prices, day):
    low = series.lowest(prices({1: ("2024-01-01", [3, 1, 2, 1])}).select("date", "nav"), "nav").first()
    assert (low.date, low.nav) == (day("2024-01-02"), 1.0)


def test_every_kth_counts_present_values(prices):
    kept = series.every_kth(prices({1: ("2024-01-01", range(1, 13))}), 5, "amfi_code", "nav")
    assert sorted(r.nav for r in kept.collect()) == [1.0, 6.0, 11.0]


def test_pivot_rejects_duplicates(prices):
    good = prices({1: ("2024-01-01", [1, 2]), 2: ("2024-01-02", [5])})
    wide = {r.date.day: (r["1"], r["2"]) for r in reshape.pivot_unique(good, "date", "amfi_code", "nav", [1, 2]).collect()}
    assert wide == {1: (1.0, None), 2: (2.0, 5.0)}
    with pytest.raises(Exception, match="duplicate entry"):
        reshape.pivot_unique(good.union(good), "date", "amfi_code", "nav", [1, 2]).collect()


def test_reconcile_both_ways(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "amfi_code BIGINT")
    b = spark.createDataFrame([("2",), ("3",)], "amfi_code STRING")
    assert {(r.code, r.side) for r in sets.reconcile_keys(a, b, "amfi_code").collect()} == {("1", "missing"), ("3", "extra")}


def test_surplus_rows_treat_missing_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (2, None)], "a INT, b STRING")
    assert aggregates.surplus_rows(df).first().duplicate_rows == 1


def test_regression_needs_thirty_rows(spark):
    rows = [("a", float(i), 2.0 * i + 1) for i in range(29)] + [("b", float(i), 2.0 * i + 1) for i in range(30)]
    fit = aggregates.regression(F.col("y"), F.col("x"))
    out = by_key(spark.createDataFrame(rows, "k STRING, x DOUBLE, y DOUBLE").groupBy("k").agg(*[v.alias(n) for n, v in fit.items()]), "k")
    assert out["a"].beta is None and out["a"].regression_observations == 29
    assert out["b"].beta == pytest.approx(2.0) and out["b"].alpha_daily == pytest.approx(1.0) and out["b"].r_squared == pytest.approx(1.0)


def test_constraint_violations(spark):
    parent = spark.createDataFrame([(1,), (2,)], "fund_key INT")
    fact = spark.createDataFrame([(1, 20240101, 5.0), (1, 20240101, 5.0), (9, 20240102, -1.0), (2, 20240103, None)], "fund_key INT, date_key INT, nav DOUBLE")
    rules = constraints.TableRules(not_null=("nav",), checks={"nav": F.col("nav") > 0}, unique=[["fund_key", "date_key"]], foreign={"fund_key": "dim"})
    report = {r.rule: r.violations for r in constraints.violations("fact", fact, rules, {"dim": parent}).collect()}
    assert report == {"not null: nav": 1, "check: nav": 1, "unique: fund_key, date_key": 1, "foreign key: fund_key -> dim": 1}


def test_reconciled_keys_are_sorted(spark):
    a = spark.createDataFrame([(i,) for i in (5, 3, 9, 1)], "k BIGINT")
    b = spark.createDataFrame([(i,) for i in (8, 3, 7, 2)], "k BIGINT")
    assert [tuple(r) for r in sets.reconcile_keys(a, b, "k").collect()] == [("2", "extra"), ("7", "extra"), ("8", "extra"), ("1", "missing"), ("5", "missing"), ("9", "missing")]
