"""Grouped and global aggregates with the reference semantics for missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.operators.selection import exact_quantiles
from fundlake.schemas import MIN_REGRESSION_ROWS


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, missing values ignored, the commonest first; equal counts by value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(column))


def with_share(df: DataFrame, value: str, out: str, scale: float = 1.0) -> DataFrame:
    """Share of the column total; the total is a one-row subquery, not a global window."""
    total = df.select(F.sum(value).cast("double")).scalar()
    return df.withColumn(out, F.col(value) * F.lit(scale) / total)


def sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def downside_deviation(returns: Column) -> Column:
    """Sample deviation of the negative returns only."""
    return F.stddev_samp(F.when(returns < 0, returns))


def regression(y: Column, x: Column, least: int = MIN_REGRESSION_ROWS) -> Mapping[str, Column]:
    """Slope, intercept, r squared and row count; NULL below ``least`` matched rows."""
    n = F.regr_count(y, x)
    both = x.isNotNull() & y.isNotNull()
    r = F.corr(F.when(both, x), F.when(both, y))
    return {
        "beta": F.when(n >= least, F.regr_slope(y, x)),
        "alpha_daily": F.when(n >= least, F.regr_intercept(y, x)),
        "r_squared": F.when(n >= least, r * r),
        "regression_observations": n,
    }


def beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row table to every row, as a scalar subquery."""
    row = one_row.select(F.struct(*one_row.columns)).scalar()
    return df.withColumn("__row", row).select(*df.columns, *[F.col(f"__row.{c}").alias(c) for c in one_row.columns])


def distribution(df: DataFrame, value: str, points: Mapping[str, float]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quantiles of one column."""
    basics = df.agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )
    return beside(basics, exact_quantiles(df, value, points))


def null_counts(df: DataFrame) -> DataFrame:
    """``(column, nulls)`` from one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in df.columns])
    return counts.select(F.inline(entries))


#: Flags a number holds.
MASK_BITS = 62


def masks(flags: Sequence[Column]) -> list[Column]:
    """Flags packed into as few numbers as hold them; flag i is bit i % MASK_BITS of number i // MASK_BITS."""
    packed = []
    for lo in range(0, len(flags), MASK_BITS):
        bits = [F.when(flag, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, flag in enumerate(flags[lo : lo + MASK_BITS])]
        packed.append(reduce(lambda x, y: x.bitwiseOR(y), bits))
    return packed


def row_identity(columns: Sequence[str]) -> list[Column]:
    """Numbers that are equal for equal rows: 128 bits of hash, and which values are missing (a hash passes over those)."""
    values = [F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(*values), F.xxhash64(F.lit("second"), *values), *masks([v.isNull() for v in values])]


def surplus_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many rows repeat an earlier row; missing values compare equal. What is shuffled are row identities, not rows."""
    named = [part.alias(f"__{i}") for i, part in enumerate(row_identity(columns or df.columns))]
    copies = df.select(*named).groupBy(*[f"__{i}" for i in range(len(named))]).agg(F.count("*").alias("__n"))
    return copies.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"))


def quantiles(df: DataFrame, value: str, points: Mapping[str, float], groups: Sequence[str] = ()) -> DataFrame:
    return exact_quantiles(df, value, points, groups)


def above_trimmed_ceiling(df: DataFrame, value: str, p: float = 0.99, factor: float = 1.1) -> DataFrame:
    """Rows at or below ``factor`` times the exact global p-quantile."""
    ceiling = exact_quantiles(df, value, {"q": p}).select(F.col("q") * factor).scalar()
    return df.where(F.col(value) <= ceiling)
