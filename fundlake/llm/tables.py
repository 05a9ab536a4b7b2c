"""Stored intermediate tables and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later jobs read files that every executor reaches, so a lost executor costs
    a few tasks and no recomputation. ``session.clear_scratch`` deletes them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(table: DataFrame) -> None:
    """Delete the files of a ``stored`` table that no later job reads."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, component) for every node of (a, b) links; component: its smallest node.

    Alternates large-star and small-star steps until the links no longer change. Each
    step is an aggregate and an equi-join on the node, so the neighbours of a hub are
    never gathered: minima are partial sums of the map side, and a hub's rows in the
    join can be split by the adaptive planner. O(log^2) rounds. Nodes must not be null.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name)
    while True:
        before = _signature(edges)
        if before[0] == 0:
            break
        edges = stored(_small_star(_large_star(edges)), name)
        if _signature(edges) == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node sends its larger neighbours to the smallest node of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node sends its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
