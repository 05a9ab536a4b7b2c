"""Set comparisons between key columns and value lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile_keys(master: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Keys found on one side only: ``(code, side)`` with side missing or extra.

    Keys are compared as text and each side's list is sorted. One shuffle over distinct keys covers both ways.
    """
    tagged = master.select(F.col(key).cast("string").alias("code"), F.lit(1).alias("m"), F.lit(0).alias("o")).unionByName(
        other.select(F.col(key).cast("string").alias("code"), F.lit(0).alias("m"), F.lit(1).alias("o"))
    )
    return (
        tagged.where(F.col("code").isNotNull())
        .groupBy("code").agg(F.max("m").alias("m"), F.max("o").alias("o"))
        .where(F.col("m") != F.col("o"))
        .select("code", F.when(F.col("m") == 1, "missing").otherwise("extra").alias("side"))
        .orderBy("side", "code")
    )


def outside_allowed(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """One row with the number of values outside the allowed list."""
    return df.agg(F.count_if(~F.col(column).isin(*allowed)).alias("violations")).select(
        F.lit(column).alias("column"), "violations"
    )


def shared_order(df: DataFrame, label: str, order: Sequence[str]) -> DataFrame:
    """Keep labels of a fixed list and add their position in it."""
    position = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(label))
    return df.withColumn("position", position).where(F.col("position") > 0)
