"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.operators.constraints import required


def _listed(df: DataFrame, columns: str, wanted: Sequence) -> DataFrame:
    """Rows with a key; a key that is not listed fails the query instead of vanishing."""
    return required(df.where(F.col(columns).isNotNull()), F.col(columns).isin(*wanted), "pivot key not listed")


def pivot_unique(df: DataFrame, index: str, columns: str, values: str, wanted: Sequence) -> DataFrame:
    """Wide table with one column per wanted key; a repeated cell or a key not listed fails the query."""
    cells = _listed(df, columns, wanted).groupBy(index, columns).agg(F.count(values).alias("__n"), F.max(values).alias(values))
    cells = required(cells, F.col("__n") <= 1, "duplicate entry in pivot")
    return cells.groupBy(index).pivot(columns, list(wanted)).agg(F.max(values))


def pivot_grid(df: DataFrame, index: str, columns: str, values: str, wanted: Sequence) -> DataFrame:
    """As ``pivot_unique``, absent cells 0."""
    return pivot_unique(df, index, columns, values, wanted).fillna(0)


def pivot_sum(df: DataFrame, index: str, columns: str, values: str, wanted: Sequence) -> DataFrame:
    """Wide sums, absent cells 0; repeated cells add up."""
    return _listed(df, columns, wanted).groupBy(index).pivot(columns, list(wanted)).agg(F.sum(values)).fillna(0)


def pivot_mean(df: DataFrame, index: str, columns: str, values: str, wanted: Sequence) -> DataFrame:
    return _listed(df, columns, wanted).groupBy(index).pivot(columns, list(wanted)).agg(F.avg(values))


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], label: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), label, value)


def with_row_total(df: DataFrame, values: Sequence[str], out: str = "row_total") -> DataFrame:
    total = F.lit(0)
    for name in values:
        total = total + F.col(f"`{name}`")
    return df.withColumn(out, total)
