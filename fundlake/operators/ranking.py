"""Exact global order statistics without a single-task window.

A window with no partition columns sends every row to one task. The functions
here range-sort the rows instead, store each row's slice number with it (so a
recomputed task can never disagree about it), and add the number of rows in the
slices before. What is brought together is one count per slice. There is one way
for every size. NaN counts as missing, as NULL does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.operators.selection import known
from fundlake.session import cut_lineage

SLICE = "__slice"


def range_slices(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` range-sorted into slices of like size, stored, with the slice number of each row."""
    return cut_lineage(df.repartitionByRange(*order).withColumn(SLICE, F.spark_partition_id()))


def row_numbers(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Dense 1..N over the whole table in the given total order."""
    slices = range_slices(df, order)
    running = Window.orderBy(SLICE)
    starts = (
        slices.groupBy(SLICE).agg(F.count("*").alias("__n"))
        .select(SLICE, (F.sum("__n").over(running) - F.col("__n")).alias("__start"))
    )
    inside = Window.partitionBy(SLICE).orderBy(*order)
    return (
        slices.join(F.broadcast(starts), SLICE)
        .withColumn(out, F.row_number().over(inside) + F.col("__start"))
        .drop(SLICE, "__start")
    )


def cumulative_counts(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Distinct values with ``n`` (copies), ``before`` (rows below), ``total`` rows.

    Copies are counted before the first exchange, so one value or one group may
    hold most of the rows. Rows with a missing value or group are left out.
    """
    present = known(df, value)
    for name in groups:
        present &= F.col(name).isNotNull()
    counts = df.where(present).groupBy(*groups, value).agg(F.count("*").alias("n"))
    slices = range_slices(counts, [*groups, value])
    per_slice = slices.groupBy(*groups, SLICE).agg(F.sum("n").alias("__slice_n"))
    running = Window.partitionBy(*groups).orderBy(SLICE)
    starts = per_slice.select(
        *groups, SLICE,
        (F.sum("__slice_n").over(running) - F.col("__slice_n")).alias("__start"),
        F.sum("__slice_n").over(running.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    inside = Window.partitionBy(*groups, SLICE).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        slices.withColumn("__upto", F.sum("n").over(inside))
        .join(starts, [*groups, SLICE])
        .select(*groups, value, "n", (F.col("__start") + F.col("__upto") - F.col("n")).alias("before"), "total")
    )


def min_ranks(df: DataFrame, metrics: Mapping[str, tuple[str, bool]]) -> DataFrame:
    """Add one min-rank per ``out -> (column, ascending)``; missing values get none.

    Values keep their own type. Metrics of one type share one sort of their distinct
    values. A rank belongs to a value and is joined to the rows by it, so repeated keys
    and equal rows are ranked like any others.
    """
    of_type: dict[str, list[str]] = {}
    for out, (name, _) in metrics.items():
        of_type.setdefault(df.schema[name].dataType.simpleString(), []).append(out)
    ranked = df
    for outs in of_type.values():
        entries = F.array(*[F.struct(F.lit(out).alias("__metric"), F.col(metrics[out][0]).alias("__value")) for out in outs])
        positions = cumulative_counts(df.select(F.inline(entries)), "__value", ["__metric"])
        upward, downward = F.col("before") + 1, F.col("total") - F.col("before") - F.col("n") + 1
        ranks = positions.select("__metric", "__value", upward.alias("__up"), downward.alias("__down"))
        for out in outs:
            name, ascending = metrics[out]
            one = ranks.where(F.col("__metric") == out).select(F.col("__value").alias(f"__{out}"), F.col("__up" if ascending else "__down").alias(out))
            # NaN equals NaN in a join, but no rank was given to it.
            ranked = ranked.join(one, F.col(name) == F.col(f"__{out}"), "left").drop(f"__{out}")
    return ranked


def top_n_with_rest(
    df: DataFrame, label: str, value: str, n: int, rest: str = "Others"
) -> DataFrame:
    """The n largest rows, plus one row for the remainder when that is above zero. One row per label in ``df``.

    Rows without a label are left out of both. The n-th row is the border that every row is held against: a comparison
    with a value of ``df`` is not pushed below the aggregate that made it, so both evaluations share its exchange.
    """
    named = df.where(F.col(label).isNotNull()).select(label, value)
    place = F.struct(F.col(value).isNull(), -F.col(value), F.col(label))
    border = named.orderBy(F.desc(value), F.asc(label)).limit(n).agg(F.max(place)).scalar()
    kept = place <= border
    sided = named.select(kept.alias("__kept"), F.when(kept, F.col(label)).otherwise(F.lit(rest)).alias(label), value)
    totals = sided.groupBy("__kept", label).agg(F.sum(value).alias(value))
    return totals.where(F.col("__kept") | (F.col(value) > 0)).select(label, value)
