import numpy as np
import pytest

from fundlake.operators.selection import exact_quantiles
from tools.executed import executed_nodes

POINTS = {"lo": 0.0, "p01": 0.01, "q1": 0.25, "median": 0.5, "p777": 0.777, "p99": 0.99, "hi": 1.0}


@pytest.mark.parametrize("accuracy", [50, 200, 10_000])
@pytest.mark.parametrize("kind", ["normal", "ties", "steps", "wide"])
def test_quantiles_of_large_and_small_groups(spark, accuracy, kind):
    """With a coarse sketch the brackets are a small part of each group; groups from one row to most rows."""
    rng = np.random.default_rng(1)
    sizes = {"hot": 20_000, "middle": 801, "edge": 200, "few": 3, "one": 1}
    make = {"normal": rng.normal, "ties": lambda size: rng.integers(0, 4, size).astype(float), "steps": lambda size: np.floor(rng.exponential(size=size) * 9),
            "wide": lambda size: np.sign(rng.normal(size=size)) * 10.0 ** rng.integers(-300, 300, size)}[kind]
    values = {g: make(size=n) for g, n in sizes.items()}
    rows = [(g, float(v)) for g, found in values.items() for v in found] + [("hot", None), ("hot", float("nan")), (None, 1.0), ("none", None)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE").repartition(7)
    got = {r.g: r for r in exact_quantiles(df, "v", POINTS, ["g"], accuracy).collect()}
    assert set(got) == set(sizes)
    for g, found in values.items():
        for name, p in POINTS.items():
            assert got[g][name] == pytest.approx(np.quantile(found, p), rel=1e-12, abs=1e-12), (g, name)
    whole = exact_quantiles(df.where("g = 'hot'"), "v", POINTS, (), accuracy).first()
    assert [whole[name] for name in POINTS] == [got["hot"][name] for name in POINTS]


def test_integers_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 5), (1, 8), (1, 2)], "g INT, v BIGINT")
    assert exact_quantiles(df, "v", {"m": 0.5, "q": 0.75}, ["g"]).collect() == [(1, 5.0, 6.5)]
    assert exact_quantiles(df.limit(0), "v", {"m": 0.5}).collect() == [(None,)]
    assert exact_quantiles(df.limit(0), "v", {"m": 0.5}, ["g"]).collect() == []


def test_no_sort_of_all_values_and_nothing_stored(spark, tmp_path):
    spark.range(50_000).selectExpr("id % 3 AS g", "cast(id * 7919 % 50021 as double) AS v").write.parquet(str(tmp_path / "t"))
    nodes = executed_nodes(exact_quantiles(spark.read.parquet(str(tmp_path / "t")), "v", POINTS, ["g"], 100))
    assert nodes["FileSourceScanExec"] == 2 and nodes["RDDScanExec"] == 0
