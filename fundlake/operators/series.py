"""Operators on long ``(key, date, value)`` series.

A series holds at most one row per calendar day once duplicates are gone, so a
window over one series is bounded by the calendar (36,525 rows per century)
however large the table is. Dedup first; hot days are reduced before the shuffle.
All windows use the same spec, so one exchange and one sort serve them all.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def along(key: str, date: str = "date") -> WindowSpec:
    return Window.partitionBy(key).orderBy(date)


def so_far(key: str, date: str = "date") -> WindowSpec:
    return along(key, date).rowsBetween(Window.unboundedPreceding, 0)


def whole(key: str, date: str = "date") -> WindowSpec:
    return along(key, date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def previous(value: str, key: str, date: str = "date") -> Column:
    return F.lag(value).over(along(key, date))


def change(value: str, key: str, date: str = "date") -> Column:
    """Relative change against the row before."""
    return F.col(value) / previous(value, key, date) - 1


def running_max(value: str, key: str, date: str = "date") -> Column:
    return F.max(value).over(so_far(key, date))


def forward_filled(value: str, key: str, date: str = "date") -> Column:
    return F.last(value, ignorenulls=True).over(so_far(key, date))


def first_of_series(value: str, key: str, date: str = "date") -> Column:
    return F.first(value).over(so_far(key, date))


def fill_calendar(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """One row per day from each series' first to its last day, values carried on.

    Every row covers the days up to the next row of its series. That is the
    forward fill on a daily spine, without building the spine or joining to it.
    """
    next_day = F.lead(date).over(along(key, date))
    until = F.coalesce(F.date_sub(next_day, 1), F.col(date))
    return df.select(key, date, value, until.alias("__until")).select(
        key, F.explode(F.sequence(F.col(date), F.col("__until"))).alias(date), value
    )


def calendar_spine(df: DataFrame, key: str, date: str) -> DataFrame:
    """Every day of each series' own span."""
    spans = df.groupBy(key).agg(F.min(date).alias("__from"), F.max(date).alias("__to"))
    return spans.select(key, F.explode(F.sequence("__from", "__to")).alias(date))


def reindex_daily(df: DataFrame, key: str, date: str) -> DataFrame:
    """Left join onto the daily spine; days without a row stay missing."""
    return calendar_spine(df, key, date).join(df, [key, date], "left")


def every_kth(df: DataFrame, k: int, key: str, value: str, date: str = "date") -> DataFrame:
    """Rows 1, k+1, 2k+1, ... of each series, counted after dropping missing values."""
    numbered = df.where(F.col(value).isNotNull()).withColumn("__i", F.row_number().over(along(key, date)))
    return numbered.where((F.col("__i") - 1) % k == 0).drop("__i")


def rebase_to_first_day(df: DataFrame, key: str, value: str, date: str = "date", out: str = "indexed") -> DataFrame:
    """100 on the first day of the *whole table*; series that start later stay missing."""
    opening = df.select(F.min(date)).scalar()
    base = F.when(F.first(date).over(so_far(key, date)) == opening, first_of_series(value, key, date))
    return df.withColumn(out, F.col(value) / base * 100)


def rebase_to_own_start(df: DataFrame, key: str, value: str, date: str = "date", out: str = "normalized_value") -> DataFrame:
    """100 on each series' own first day."""
    return df.withColumn(out, F.col(value) / first_of_series(value, key, date) * 100)


def growth(df: DataFrame, value: str, date: str) -> DataFrame:
    """First and last value of one series with absolute and relative growth."""
    ends = df.agg(
        F.min(F.struct(date, value)).alias("a"), F.max(F.struct(date, value)).alias("b")
    ).select(F.col(f"a.{value}").alias("first_value"), F.col(f"b.{value}").alias("last_value"))
    return ends.select(
        "first_value", "last_value",
        (F.col("last_value") - F.col("first_value")).alias("growth_abs"),
        ((F.col("last_value") / F.col("first_value") - 1) * 100).alias("growth_pct"),
    )


def as_of(df: DataFrame, target: Column, key: str, value: str, date: str = "date") -> DataFrame:
    """Last row of each series on or before ``target`` (an expression over the row)."""
    hit = F.max(F.when(F.col(date) <= target, F.struct(date, value)))
    return df.groupBy(key).agg(hit.alias("__hit")).select(
        key, F.col(f"__hit.{date}").alias(date), F.col(f"__hit.{value}").alias(value)
    )


def nearest_to_markers(df: DataFrame, markers: Mapping[str, str], value: str, date: str) -> DataFrame:
    """For each ``label -> ISO day`` the row closest in days, the earlier one on ties.

    One aggregate per marker in a single pass; nothing is joined.
    """
    closest = F.array(*[
        F.struct(
            F.lit(label).alias("label"),
            F.lit(day).cast("date").alias("marker_date"),
            F.min(F.struct(F.abs(F.datediff(F.col(date), F.lit(day).cast("date"))), F.col(date), F.col(value))).alias("hit"),
        )
        for label, day in markers.items()
    ])
    return df.agg(closest.alias("all")).select(F.inline("all")).select(
        "label", "marker_date", F.col(f"hit.{date}").alias(date), F.col(f"hit.{value}").alias(value)
    )


def lowest(df: DataFrame, value: str, date: str = "date") -> DataFrame:
    """The row with the smallest value, the first one on ties."""
    low = df.where(F.col(value).isNotNull()).agg(F.min(F.struct(value, date)).alias("low"))
    return low.select(F.col(f"low.{date}").alias(date), F.col(f"low.{value}").alias(value))


def highest(df: DataFrame, label: str, value: str) -> DataFrame:
    """The label with the largest value, the first label on ties; no row if there is none. One aggregate."""
    top = df.where(F.col(value).isNotNull()).agg(F.min(F.struct((-F.col(value)).alias("v"), F.col(label).alias("l"))).alias("t"))
    return top.where("t IS NOT NULL").select(F.col("t.l").alias(label), (-F.col("t.v")).alias(value))
