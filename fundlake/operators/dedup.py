"""Keep one row per key.

``row_number() = 1`` is planned with a group limit *before* the exchange, so each
map task ships at most one row per key: a key holding most of the input costs no
more to shuffle than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POSITION = "__position"


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # Led by one hash, the sort compares a number first and key texts only within a key.
    lead = [F.xxhash64(*keys)] if len(keys) > 1 else []
    spec = Window.partitionBy(*lead, *keys).orderBy(*order)
    return df.withColumn(_POSITION, F.row_number().over(spec)).where(F.col(_POSITION) == 1).drop(_POSITION)


def keep_last(df: DataFrame, keys: Sequence[str], order: str = "ingest_seq") -> DataFrame:
    return _one_per_key(df, keys, [F.col(order).desc()])


def keep_first(df: DataFrame, keys: Sequence[str], order: str = "ingest_seq") -> DataFrame:
    return _one_per_key(df, keys, [F.col(order).asc()])


def latest_per_group(df: DataFrame, keys: Sequence[str], *newest_first: Column) -> DataFrame:
    """Newest row of each group; give enough keys for a total order."""
    return _one_per_key(df, keys, newest_first)


def distinct_rows(df: DataFrame, ignore: Sequence[str] = ("ingest_seq",)) -> DataFrame:
    """Full-row dedup over every column but the arrival position."""
    return df.drop(*ignore).dropDuplicates()


def distinct_dates(*dated: tuple[DataFrame, str]) -> DataFrame:
    """One row per date found in any of the given columns.

    Each input is made distinct on its own before the union, so the exchange
    carries days, not facts.
    """
    days = [df.select(F.col(name).cast("date").alias("full_date")).distinct() for df, name in dated]
    union = days[0]
    for more in days[1:]:
        union = union.unionByName(more)
    return union.where(F.col("full_date").isNotNull()).distinct()


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value)`` for every distinct value of the listed columns."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value"))
        for name in columns
    ])
    return df.select(F.inline(pairs)).distinct()
