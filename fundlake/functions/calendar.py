"""Date parts, keys, flags and offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlake.schemas import DAYS_PER_YEAR


def date_key(d: Column) -> Column:
    """20240229 for 29 February 2024."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def is_weekend(d: Column) -> Column:
    return F.weekday(d).isin(5, 6).cast("int")


def is_month_end(d: Column) -> Column:
    return (d == F.last_day(d)).cast("int")


def years_before(d: Column, years: int) -> Column:
    """Same day ``years`` earlier; 29 February falls back to the 28th."""
    return F.add_months(d, -12 * years)


def years_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start) / F.lit(DAYS_PER_YEAR)


def calendar_columns(d: Column) -> list[Column]:
    """Every column of the date dimension for one date."""
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        is_weekend(d).alias("is_weekend"),
        is_month_end(d).alias("is_month_end"),
    ]
