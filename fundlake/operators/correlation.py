"""Correlation of many series by blocks: the plan is the same for ten series and for ten thousand.

Series get numbers and stand in blocks of ``block``. A day gives one vector per block; a vector's values, one by one, meet
the vectors of the blocks from their own on. A row there carries one value against a whole block, so the sums
are ``block`` aggregates whatever the number of series, combined before the shuffle: what is exchanged is a row per
(series, block) and task. Values are centred first, so sums of products lose no digits to large means.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.operators.ranking import row_numbers

BLOCK = 32


def complete_days(values: DataFrame, key: str, value: str, at: str, keys: DataFrame) -> DataFrame:
    """The rows of days on which every one of ``keys`` has a value; one row a key and day."""
    known = values.where(F.col(value).isNotNull() & F.col(at).isNotNull()).select(key, at, value).join(keys.select(key), key, "left_semi")
    full = known.groupBy(at).agg(F.count("*").alias("__n")).where(F.col("__n") == keys.select(F.count("*")).scalar()).select(at)
    return known.join(full, at, "left_semi")


def correlations(values: DataFrame, key: str, value: str, at: str = "date", keys: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """``(code_a, code_b, days, correlation)`` for every pair with code_a <= code_b, over the days that all series have.

    ``keys``: the series to compare, one row each (default: all of ``values``). ``values`` holds one row per series and ``at``. A
    series that does not vary has no correlation (null), nor has any with a single day.
    """
    keys = values.where(F.col(key).isNotNull()).select(key).distinct() if keys is None else keys.select(key)
    numbered = row_numbers(keys, [F.col(key).asc()], "__no").select(
        key, F.floor((F.col("__no") - 1) / block).cast("int").alias("__block"), ((F.col("__no") - 1) % block).cast("int").alias("__place"))
    rows = complete_days(values, key, value, at, numbered)
    means = rows.groupBy(F.col(key).alias("__key")).agg(F.avg(value).alias("__mean"))
    centred = rows.join(means, F.col(key) == F.col("__key")).join(numbered, key).select(at, "__block", "__place", (F.col(value) - F.col("__mean")).alias("__x"))
    # On a full day a block's vector has no holes, so places follow each other.
    vectors = centred.groupBy(at, "__block").agg(F.array_sort(F.collect_list(F.struct("__place", "__x"))).alias("__v")).select(
        at, "__block", F.col("__v.__x").alias("__v"))
    singles = vectors.select(F.col(at).alias("__day"), F.col("__block").alias("__block_a"), F.posexplode("__v").alias("__place_a", "__own"))
    met = singles.join(vectors, (F.col("__day") == F.col(at)) & (F.col("__block") >= F.col("__block_a")))
    sums = F.array(*[F.sum(F.col("__own") * F.get("__v", i)) for i in range(block)])
    moments = met.groupBy("__block_a", "__place_a", "__block").agg(F.count("*").alias("days"), sums.alias("__sums"))
    cells = moments.select(
        (F.col("__block_a") * block + F.col("__place_a")).alias("__a"), "__block", "days", F.posexplode("__sums").alias("__place", "__sum")
    ).select("__a", (F.col("__block") * block + F.col("__place")).alias("__b"), "days", "__sum").where("__sum IS NOT NULL AND __a <= __b")
    own = cells.where("__a = __b").select(F.col("__a").alias("__i"), F.col("__sum").alias("__var"))
    names = numbered.select((F.col("__block") * block + F.col("__place")).alias("__i"), key)
    side = own.join(names, "__i")
    both = cells.join(side.toDF("__a", "__var_a", "code_a"), "__a").join(side.toDF("__b", "__var_b", "code_b"), "__b")
    spread = F.sqrt(F.col("__var_a")) * F.sqrt(F.col("__var_b"))
    return both.select("code_a", "code_b", "days", F.when(spread > 0, F.col("__sum") / spread).alias("correlation"))
