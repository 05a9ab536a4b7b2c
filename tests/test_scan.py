import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fundlake.operators import scan, series
from fundlake.operators.ranking import SLICE, range_slices
from fundlake.operators.scan import Running
from fundlake.plans import returns

DAY = dt.date(2020, 1, 1)


@pytest.fixture(scope="module", autouse=True)
def small_slices(spark):
    """Small tables would be coalesced into one slice."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def ticks(spark):
    """Nine tenths of the rows in one series; nulls in values, keys and positions."""
    rng = random.Random(3)
    rows = [(None if k % 97 == 0 else "hot" if rng.random() < 0.9 else f"s{rng.randrange(5)}", None if k % 89 == 0 else k * 7919 % 10007, k,
             None if rng.random() < 0.4 else rng.randrange(100)) for k in range(4000)]
    return spark.createDataFrame(rows, "series STRING, at INT, id INT, v INT")


def test_a_long_series_lies_in_several_slices(ticks):
    slices = range_slices(ticks, ["series", "at", "id"]).where("series = 'hot'").groupBy(SLICE).count().collect()
    assert len(slices) >= 3 and max(r["count"] for r in slices) < 2000


@pytest.mark.parametrize("kind", ["max", "min", "sum", "known", "next"])
def test_running_values_equal_windows(ticks, kind):
    over = Window.partitionBy("series").orderBy("at", "id")
    upto = over.rowsBetween(Window.unboundedPreceding, 0)
    plain = {"max": F.max("v").over(upto), "min": F.min("v").over(upto), "sum": F.sum("v").over(upto), "known": F.last("v", True).over(upto), "next": F.lead("v").over(over)}
    want = {r.id: r.out for r in ticks.withColumn("out", plain[kind]).collect()}
    got = scan.running(ticks, ["series"], ["at", "id"], {"out": Running(kind, "v")})
    assert got.columns == [*ticks.columns, "out"]
    assert {r.id: r.out for r in got.collect()} == want


def test_several_running_values_share_one_scan(ticks):
    both = scan.running(ticks, ["series"], ["at", "id"], {"a": Running("max", "v"), "b": Running("known", "v")})
    assert both.where("a < b").count() == 0 and both.count() == ticks.count()


def test_calendar_fill_equals_the_window_version(spark):
    rng = random.Random(4)
    days = {"hot": rng.sample(range(3000), 900), "one": [5], "x": rng.sample(range(400), 30)}
    rows = [(k, DAY + dt.timedelta(days=d), rng.random() if d % 9 else None) for k, found in days.items() for d in found]
    df = spark.createDataFrame(rows, "k STRING, day DATE, v DOUBLE")
    assert sorted(scan.fill_calendar(df, "k", "day", "v").collect(), key=str) == sorted(series.fill_calendar(df, "k", "day", "v").collect(), key=str)


def test_as_of_join_against_a_loop(spark):
    rng = random.Random(5)
    keys = ["hot"] * 12 + ["a", "b", None]
    left = [(rng.choice(keys), None if rng.random() < 0.02 else rng.randrange(500), k) for k in range(1500)]
    right = [(rng.choice(keys), None if rng.random() < 0.02 else rng.randrange(500), rng.randrange(9)) for k in range(700)] + [("right only", 3, 1)]
    probes = spark.createDataFrame(left, "key STRING, at INT, id INT")
    marks = spark.createDataFrame(right, "key STRING, moment INT, v INT")
    got = {r.id: (r.moment_as_of, r.v) for r in scan.as_of_join(probes, marks, ["key"], "at", ["v"], "moment").collect()}
    near = {r.id: (r.moment_as_of, r.v) for r in scan.as_of_join(probes, marks, ["key"], "at", ["v"], "moment", tolerance=F.col("at") - 1).collect()}
    assert len(got) == len(near) == len(left)
    for key, at, k in left:
        best = max(((m, v) for other, m, v in right if other == key and m is not None and m <= at), default=(None, None)) if key is not None and at is not None else (None, None)
        assert got[k] == best
        assert near[k] == (best if best[0] is not None and best[0] >= at - 1 else (None, None))


def test_as_of_join_of_empty_sides_and_clashing_names(spark, ticks):
    none = ticks.limit(0).withColumnRenamed("v", "w")
    left = ticks.limit(50)
    got = scan.as_of_join(left, none, ["series"], "at", ["w"]).collect()
    assert len(got) == 50 and all(r.w is None and r.at_as_of is None for r in got)
    assert scan.as_of_join(left.limit(0), ticks.withColumnRenamed("v", "w"), ["series"], "at", ["w"]).count() == 0
    with pytest.raises(ValueError, match="names of both sides"):
        scan.as_of_join(left, ticks, ["series"], "at", ["v"])


def test_drawdown_by_slices_equals_windows_with_ties(spark, prices):
    rng = random.Random(6)
    walks = {}
    for code in range(40):
        level, path = 20.0, []
        for _ in range(900 if code == 0 else rng.randrange(1, 60)):
            level = max(1.0, level + rng.choice((-2, -1, 0, 1, 2)))
            path.append(level)
        walks[code] = ("2020-01-01", path)
    walks[50], walks[51], walks[52] = ("2020-01-01", [5, 5, 5]), ("2020-01-01", [3, 2, 3, 2, 3]), ("2020-01-01", [1, 2, 3])
    nav = prices(walks)
    want = sorted(returns.max_drawdown(nav).collect())
    assert sorted(returns.max_drawdown_by_slices(nav).collect()) == want and len(want) == 43


def test_drawdown_record_across_slices(spark, prices, monkeypatch):
    # One row a slice: everything is decided by merging records.
    monkeypatch.setattr(returns, "range_slices", lambda df, order: df.withColumn(SLICE, F.unix_date("date")))
    rng = random.Random(7)
    nav = prices({code: ("2020-01-01", [float(rng.randrange(1, 9)) for _ in range(25)]) for code in range(60)})
    assert sorted(returns.max_drawdown_by_slices(nav).collect()) == sorted(returns.max_drawdown(nav).collect())
