"""Exact quantiles by a sketch and a count: two scans, no sort of all values, nothing stored.

The first scan makes a quantile sketch per group, which encloses every point's position between two values a
fraction of about 6 / ACCURACY of the rows apart (whole groups up to a few times ACCURACY rows). The second counts the values inside these
brackets, each value once, and only how many rows lie below them. What is shuffled is one sketch and those counts per group and
task, for all points at once. The count makes the result exact: a position that its bracket does not hold (which the
sketch's error bound rules out) fails the query.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rank error of the sketch is rows / ACCURACY; its size per group and task is in proportion to it.
ACCURACY = 10_000


def known(df: DataFrame, value: str) -> Column:
    """Neither null nor NaN."""
    there = F.col(value).isNotNull()
    return there & ~F.isnan(value) if df.schema[value].dataType.typeName() in ("double", "float") else there


def _brackets(rows: DataFrame, points: Sequence[float], groups: Sequence[str], accuracy: int) -> DataFrame:
    """Per group its rows, and the least and largest value that can stand at each point's position."""
    margin = 3 / accuracy
    ranks = [max(p - margin, 0.0) for p in points] + [min(p + margin, 1.0) for p in points]
    sketch = F.percentile_approx("__v", ranks, accuracy)
    found = rows.groupBy(*groups).agg(F.count("*").alias("__total"), F.min("__v").alias("__least"), F.max("__v").alias("__most"), sketch.alias("__s"))
    # The position is (rows - 1) * p: in a small group the margin is less than a row.
    small = F.col("__total") < 4 * accuracy
    low = [F.when(small, F.col("__least")).otherwise(F.get("__s", i)) for i in range(len(points))]
    high = [F.when(small, F.col("__most")).otherwise(F.get("__s", len(points) + i)) for i in range(len(points))]
    return found.select(*groups, "__total", F.array(*low).alias("__low"), F.array(*high).alias("__high"))


def exact_quantiles(
    df: DataFrame, value: str, points: Mapping[str, float], groups: Sequence[str] = (), accuracy: int = ACCURACY,
) -> DataFrame:
    """Linear-interpolated quantiles, one column per ``name -> p``, one row per group.

    Rows with a missing value (null or NaN) or group are left out. Without groups there is always one row.
    """
    n = len(points)
    present = known(df, value)
    for name in groups:
        present &= F.col(name).isNotNull()
    rows = df.where(present).select(*groups, F.col(value).alias("__v"))
    brackets = _brackets(rows, list(points.values()), groups, accuracy)
    if groups:
        placed = rows.join(brackets, list(groups))
    else:
        bounds = brackets.select(F.struct("__total", "__low", "__high")).scalar()
        placed = rows.withColumn("__b", bounds).select("__v", "__b.*")

    low, high, v = [F.get("__low", i) for i in range(n)], [F.get("__high", i) for i in range(n)], F.col("__v")
    inside = reduce(lambda a, b: a | b, [(v >= low[i]) & (v <= high[i]) for i in range(n)])
    counted = placed.groupBy(*groups, F.when(inside, v).alias("__c")).agg(
        F.count("*").alias("__n"), F.first("__total").alias("__total"), F.first("__low").alias("__low"), F.first("__high").alias("__high"),
        *[F.count_if(v < low[i]).alias(f"__below_{i}") for i in range(n)])

    c = F.col("__c")
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy("__c").rowsBetween(Window.unboundedPreceding, 0)
    ordered = counted.withColumns({
        "__upto": F.sum(F.when(c.isNotNull(), F.col("__n"))).over(upto),
        # Of rows outside all brackets; those inside are in the running count.
        **{f"__under_{i}": F.sum(F.when(c.isNull(), F.col(f"__below_{i}")).otherwise(0)).over(whole) for i in range(n)}})

    results = []
    for i, (name, p) in enumerate(points.items()):
        first = F.col(f"__under_{i}") + F.col("__upto") - F.col("__n")
        place = (F.col("__total") - 1) * F.lit(float(p))
        here = (c >= low[i]) & (c <= high[i])

        def at(index: Column, first: Column = first, here: Column = here) -> Column:
            return F.max(F.when(here & (first <= index) & (index < first + F.col("__n")), c))

        lower, upper, share = at(F.floor(place)), at(F.ceil(place)), F.max(place - F.floor(place))
        missed = (F.max("__total") > 0) & (lower.isNull() | upper.isNull())
        answer = F.when(missed, F.raise_error(F.lit("quantile outside its bracket")).cast("double")).otherwise(lower + (upper - lower) * share)
        results.append(answer.alias(name))
    return ordered.groupBy(*groups).agg(*results)
