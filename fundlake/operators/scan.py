"""Running values along series of any length, and the as-of join built on them.

The windows of ``series`` send a whole series to one task, which the calendar bounds for prices. Ticks and
events have no such bound: one series may hold a third of all rows. Here rows are range-sorted by (series, position) into
slices of like size, whatever series they belong to, and the slice number is stored with the row (as in ``ranking``). Each
slice of a series is scanned alone, gives one summary, and gets what the slices before it (or
after it) carry over:

    value at a row = merge(value inside its slice, carry of the other slices)

What is brought together for one series is one summary a slice. Positions must be a total order within a
series for results to be unique; rows of equal position stand in one slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fundlake.operators.ranking import SLICE, range_slices


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is max, min, sum, known (last value that is not null) or next (the value of the row after)."""

    kind: str
    column: str

    def inside(self, rows: WindowSpec) -> Column:
        upto = rows.rowsBetween(Window.unboundedPreceding, 0)
        value = F.col(self.column)
        if self.kind == "next":
            return F.lead(value).over(rows)
        if self.kind == "known":
            return F.last(value, ignorenulls=True).over(upto)
        return {"max": F.max, "min": F.min, "sum": F.sum}[self.kind](value).over(upto)

    def summary(self, order: Sequence[str]) -> Column:
        value, place = F.col(self.column), F.struct(*order)
        if self.kind == "next":
            return F.min_by(value, place)
        if self.kind == "known":
            return F.max_by(value, F.when(value.isNotNull(), place))
        return {"max": F.max, "min": F.min, "sum": F.sum}[self.kind](value)

    def carry(self, summary: Column, slices: WindowSpec) -> Column:
        before = slices.rowsBetween(Window.unboundedPreceding, -1)
        if self.kind == "next":
            return F.lead(summary).over(slices)
        if self.kind == "known":
            return F.last(summary, ignorenulls=True).over(before)
        return {"max": F.max, "min": F.min, "sum": F.sum}[self.kind](summary).over(before)

    def merged(self, inside: Column, carry: Column, ends_slice: Column) -> Column:
        if self.kind == "next":
            return F.when(ends_slice, carry).otherwise(inside)
        if self.kind == "known":
            return F.coalesce(inside, carry)
        if self.kind == "sum":
            return F.coalesce(inside + carry, inside, carry)
        return F.greatest(inside, carry) if self.kind == "max" else F.least(inside, carry)


def running(df: DataFrame, key: Sequence[str], order: Sequence[str], outs: Mapping[str, Running]) -> DataFrame:
    """``df`` with one running value per ``out -> Running``, along ``order`` within each ``key``.

    A null key is a series like others; null positions come first. The rows are stored once, sorted, by the call.
    """
    slices = range_slices(df, [*key, *order])
    rows = Window.partitionBy(SLICE, *key).orderBy(*order)
    scanned = slices.withColumns({
        **{f"__in_{out}": scan.inside(rows) for out, scan in outs.items()},
        "__ends": F.lead(F.lit(1)).over(rows).isNull()})
    of_series = Window.partitionBy(*key).orderBy(SLICE)
    summaries = slices.groupBy(SLICE, *key).agg(*[scan.summary(order).alias(f"__of_{out}") for out, scan in outs.items()])
    carried = summaries.select(
        F.col(SLICE).alias("__slice_of"), *[F.col(name).alias(f"__same_{name}") for name in key],
        *[scan.carry(F.col(f"__of_{out}"), of_series).alias(f"__carry_{out}") for out, scan in outs.items()])
    same = F.col(SLICE) == F.col("__slice_of")
    for name in key:
        same &= F.col(name).eqNullSafe(F.col(f"__same_{name}"))
    # Every row has its slice's summary, so this loses and doubles none.
    return scanned.join(carried, same).select(*df.columns, *[
        scan.merged(F.col(f"__in_{out}"), F.col(f"__carry_{out}"), F.col("__ends")).alias(out) for out, scan in outs.items()])


def fill_calendar(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """One row per day from each series' first to its last day, values carried on; for series of any length.

    As ``series.fill_calendar``: each row covers the days up to the next row of its series. Days must be one row each.
    """
    with_next = running(df.select(key, date, value), [key], [date], {"__next": Running("next", date)})
    until = F.coalesce(F.date_sub("__next", 1), F.col(date))
    return with_next.select(key, F.explode(F.sequence(F.col(date), until)).alias(date), value)


def as_of_join(
    left: DataFrame, right: DataFrame, key: Sequence[str], at: str, values: Sequence[str], right_at: str | None = None,
    suffix: str = "_as_of", tolerance: Column | None = None,
) -> DataFrame:
    """Every row of ``left`` with the ``values`` of the last row of ``right`` of its key at or before ``at``.

    Adds ``<right_at><suffix>``, the position of the row found, and ``values`` (which must not be names of ``left``).
    Both sides are put in one order and the last known row of ``right`` is carried on, so many left rows may look
    at one right row and none is paired with all. Of right rows at one position the one with the largest values
    counts. ``tolerance``: an expression over ``at``, the earliest position that still counts. Left rows without a key, a position or a row
    to look at stay, with nulls. A series of any size on either side is spread over slices.
    """
    right_at = right_at or at
    clash = {*values, right_at + suffix} & set(left.columns)
    if clash:
        raise ValueError(f"names of both sides: {sorted(clash)}")
    whole = F.struct(*[F.col(f"`{name}`") for name in left.columns])
    hit = F.struct(F.col(right_at).alias("position"), *values)
    probes = left.select(*[F.col(name).alias(f"__key_{i}") for i, name in enumerate(key)], F.col(at).alias("__at"), F.lit(1).alias("__side"), whole.alias("__row"))
    marks = right.where(F.col(right_at).isNotNull()).select(
        *[F.col(name).alias(f"__key_{i}") for i, name in enumerate(key)], F.col(right_at).alias("__at"), F.lit(0).alias("__side"), hit.alias("__hit"))
    keys = [f"__key_{i}" for i in range(len(key))]
    both = marks.unionByName(probes, allowMissingColumns=True)
    # The right rows of a position come first, the largest last of them.
    found = running(both, keys, ["__at", "__side", "__hit"], {"__last": Running("known", "__hit")}).where(F.col("__side") == 1)
    known = F.lit(True)
    for name in keys:
        known &= F.col(name).isNotNull()
    last = F.when(known, F.col("__last"))
    out = found.select("__row.*", last.alias("__last"))
    if tolerance is not None:
        out = out.withColumn("__last", F.when(F.col("__last.position") >= tolerance, F.col("__last")))
    return out.select(*left.columns, F.col("__last.position").alias(right_at + suffix), *[F.col(f"__last.{name}").alias(name) for name in values])
