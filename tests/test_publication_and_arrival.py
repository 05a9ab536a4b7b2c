import gzip
import random

import pytest
from pyspark.sql import functions as F

from fundlake.operators.dedup import keep_first, keep_last
from fundlake.plans import publication
from fundlake.session import scratch_path
from fundlake.sources import files
from tests.test_sources_and_star import parts  # noqa: F401


def test_a_failing_gate_leaves_the_old_star(spark, parts):  # noqa: F811
    funds, nav, aum, perf, txns = parts
    root = scratch_path(spark, "published")
    assert publication.current(spark, root) is None and publication.versions(spark, root) == []
    with pytest.raises(FileNotFoundError):
        publication.open_star(spark, root)
    first = publication.publish(spark, root, funds, nav, aum, perf, txns)
    old = publication.open_star(spark, root)
    for broken in (
        (funds, nav, aum.withColumn("aum_crore", F.lit(-1).cast("long")), perf, txns),  # a check rule
        (funds, nav.unionByName(nav), aum, perf, txns),  # a key
        (funds, nav.withColumn("amfi_code", F.col("amfi_code") + 5), aum, perf, txns),  # rows lost in the join
    ):
        with pytest.raises(publication.GateFailed, match="not published"):
            publication.publish(spark, root, *broken)
        assert publication.current(spark, root) == first
        assert publication.open_star(spark, root)["fact_aum"].count() == 3
    with pytest.raises(Exception, match="stop"):  # a load that dies half-way
        publication.publish(spark, root, funds, nav, aum, perf, txns.withColumn("state", F.raise_error(F.lit("stop"))))
    assert publication.current(spark, root) == first

    second = publication.publish(spark, root, funds, nav, aum.limit(2), perf, txns)
    assert publication.current(spark, root) == second > first
    assert publication.open_star(spark, root)["fact_aum"].count() == 2 and old["fact_aum"].count() == 3
    gone = publication.expire(spark, root, keep=1)
    assert first in gone and second in publication.versions(spark, root)
    assert publication.open_star(spark, root)["fact_nav"].count() == 2


def test_known_gaps_are_reported_only(spark, parts):  # noqa: F811
    funds, nav, aum, perf, txns = parts
    root = scratch_path(spark, "published")
    gaps = txns.withColumn("gender", F.lit(None).cast("string"))
    publication.publish(spark, root, funds, nav, aum, perf, gaps)
    with pytest.raises(publication.GateFailed, match="gender"):
        publication.publish(spark, root, funds, nav, aum, perf, gaps, reported_only=())


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1k"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def test_arrival_order_across_files_and_blocks(spark, tmp_path, small_blocks):
    """Many blocks a file, files of unlike size dealt to tasks in any order: the last row by file name and place stays."""
    rng = random.Random(1)
    folder, lines = tmp_path / "some parts", []
    folder.mkdir()
    for name, n in (("c.csv", 30), ("a.csv", 4000), ("b.csv", 900), ("d.csv", 2500)):
        rows = [(rng.randrange(50), f"{name}{k}") for k in range(n)]
        (folder / name).write_text("key,v\n" + "".join(f"{k},{v}\n" for k, v in rows))
        lines.append((name, rows))
    lines = [row for _, rows in sorted(lines) for row in rows]
    df = files.read_csv(spark, f"file:{folder}")
    assert df.rdd.getNumPartitions() > 8 and dict(df.dtypes)["ingest_seq"] == "bigint"
    assert [(int(r.key), r.v) for r in df.orderBy("ingest_seq").collect()] == lines
    assert {int(r.key): r.v for r in keep_last(df, ["key"]).collect()} == dict(lines)
    assert {int(r.key): r.v for r in keep_first(df, ["key"]).collect()} == dict(reversed(lines))


def test_arrival_order_of_files_that_cannot_be_split(spark, tmp_path, small_blocks):
    for name in ("y.csv.gz", "x.csv.gz"):
        with gzip.open(tmp_path / name, "wt") as out:
            out.write("key,v\n" + "".join(f"{k % 7},{name}{k}\n" for k in range(5000)))
    rows = files.read_csv(spark, f"file:{tmp_path}").orderBy("ingest_seq").collect()
    assert [r.v for r in rows] == [f"{name}{k}" for name in ("x.csv.gz", "y.csv.gz") for k in range(5000)]
