"""Business rules as expressions: benchmark keys, anomaly flags, labels, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlake.schemas import (
    ANOMALY_CODES,
    BENCHMARK_RULES,
    DEFAULT_BENCHMARK,
    EXPENSE_RATIO_RANGE,
    INR_PER_CRORE,
    LABEL_REPLACEMENTS,
)


def benchmark_key(name: Column, strict: bool = False) -> Column:
    """First rule whose words occur in the upper-cased name, else the default."""
    rules = sorted(BENCHMARK_RULES, key=lambda rule: -len(rule[0])) if strict else BENCHMARK_RULES
    upper = F.upper(name)
    hits = [F.when(upper.contains(words), F.lit(key)) for words, key in rules]
    return F.coalesce(*hits, F.lit(DEFAULT_BENCHMARK))


def close_to(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def ratio(top: Column, bottom: Column) -> Column:
    """NULL instead of an error when the divisor is zero or missing."""
    return top / F.nullif(bottom, F.lit(0).cast("double"))


def pct_of(change: Column, base: Column) -> Column:
    return ratio(change.cast("double") * 100.0, base.cast("double"))


def if_positive(value: Column, guard: Column) -> Column:
    return F.when(guard > 0, value)


def in_crore(amount: Column) -> Column:
    return amount / F.lit(float(INR_PER_CRORE))


def expense_in_range(expense: Column) -> Column:
    return expense.between(*EXPENSE_RATIO_RANGE)


def anomaly_flags() -> Column:
    """The codes of the checks a performance row fails, joined with ``;``."""
    c = F.col
    checks = {
        "expense_ratio_out_of_range": ~expense_in_range(c("expense_ratio_pct")),
        "high_sharpe_ratio": c("sharpe_ratio") > 3,
        "sharpe_matches_return_3yr": close_to(c("sharpe_ratio"), c("return_3yr_pct")),
        "high_sortino_ratio": c("sortino_ratio") > 5,
        "positive_max_drawdown": c("max_drawdown_pct") > 0,
        "extreme_return_1yr": F.abs(c("return_1yr_pct")) > 50,
        "beta_out_of_range": ~c("beta").between(0, 2),
        "invalid_morningstar_rating": ~c("morningstar_rating").between(1, 5),
    }
    return F.concat_ws(";", *[F.when(checks[code], F.lit(code)) for code in ANOMALY_CODES])


def short_label(name: Column) -> Column:
    """Axis label of a fund in the correlation matrix."""
    return F.substring(F.replace(name, F.lit(" Fund"), F.lit("")), 1, 18)


def series_label(name: Column) -> Column:
    """Legend label of a series: known phrases shortened, then cut to fit."""
    for phrase, short in LABEL_REPLACEMENTS:
        name = F.replace(name, F.lit(phrase), F.lit(short))
    return F.when(F.length(name) > 34, F.concat(F.substring(name, 1, 31), F.lit("..."))).otherwise(name)
