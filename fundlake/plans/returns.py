"""Daily returns of funds and indices, and per-fund performance and risk figures.

Everything about a fund is computed from one exchange on its code: the windows
share one spec and the final aggregate reuses their partitioning. Prices and index
values are one per series and day here: rows without a key, day or value are dropped and
of several rows of a day the first to arrive stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake import schemas as S
from fundlake.functions.calendar import years_before, years_between
from fundlake.functions.coerce import existing
from fundlake.functions.rules import benchmark_key, if_positive
from fundlake.operators.aggregates import downside_deviation, regression
from fundlake.operators.dedup import keep_first
from fundlake.operators.ranking import SLICE, range_slices
from fundlake.operators.series import change, previous, so_far, whole


def _one_a_day(df: DataFrame, key: str, value: str, arrival: str | None) -> DataFrame:
    """One known value per series and day; without an arrival column the smallest, so that the choice is stable."""
    kept = keep_first(df.dropna(subset=[key, "date", value]), [key, "date"], arrival or value)
    return kept.drop(arrival) if arrival else kept


def daily_returns(nav: DataFrame, funds: DataFrame | None = None, arrival: str | None = None) -> DataFrame:
    """Price, previous price and return per fund and day, with fund columns added."""
    nav = _one_a_day(nav, "amfi_code", "nav", arrival)
    out = nav.select(
        "amfi_code", "date", "nav", previous("nav", "amfi_code").alias("previous_nav"))
    out = out.withColumn("daily_return", F.col("nav") / F.col("previous_nav") - 1)
    if funds is None:
        return out
    return out.join(existing(funds, ("amfi_code", *S.FUND_METADATA)), "amfi_code", "left")


def benchmark_returns(indices: DataFrame, arrival: str | None = None) -> DataFrame:
    indices = _one_a_day(indices, "index_name", "close_value", arrival)
    return indices.select(
        "date", "index_name", "close_value", change("close_value", "index_name").alias("benchmark_return"))


def annualised_return(returns: Column, periods: int = S.PERIODS_PER_YEAR) -> Column:
    return F.pow(F.avg(returns) + 1, F.lit(periods)) - 1


def annualised_volatility(returns: Column, periods: int = S.PERIODS_PER_YEAR) -> Column:
    return F.stddev_samp(returns) * F.sqrt(F.lit(float(periods)))


def downside_volatility(returns: Column, periods: int = S.PERIODS_PER_YEAR) -> Column:
    return downside_deviation(returns) * F.sqrt(F.lit(float(periods)))


def excess_over_risk(returns: Column, risk: Column, risk_free: float = S.RISK_FREE_RATE) -> Column:
    return if_positive((annualised_return(returns) - F.lit(risk_free)) / F.nullif(risk, F.lit(0.0)), risk)


def _with_market(daily: DataFrame, indices: DataFrame, market: str) -> DataFrame:
    series = indices.where(F.col("index_name") == market).select(
        "date", F.col("benchmark_return").alias("market_return"))
    return daily.join(series, "date", "left")


def _with_tracked(daily: DataFrame, indices: DataFrame, strict: bool = False) -> DataFrame:
    """Add the return of the index each fund is measured against, NULL if absent.

    Only the index names in the rule list can match. Index returns have one row per
    name and day, so no fund row is multiplied.
    """
    known = sorted({key for _, key in S.BENCHMARK_RULES} | {S.DEFAULT_BENCHMARK})
    series = indices.where(F.col("index_name").isin(*known)).select(
        "date", F.col("index_name").alias("tracking_benchmark"), F.col("benchmark_return").alias("tracked_return"))
    keyed = daily.withColumn("tracking_benchmark", benchmark_key(F.col("benchmark"), strict))
    return keyed.join(series, ["date", "tracking_benchmark"], "left")


def _cagr(years: int) -> Column:
    start, end = F.col(f"start_{years}y"), F.col("finish")
    observed = years_between(start.date, end.date)
    usable = (observed >= 0.95 * years) & (start.nav > 0)
    return F.when(usable, F.pow(end.nav / start.nav, F.lit(1.0) / observed) - 1)


def cagr(nav: DataFrame, years: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    """Compound annual growth per fund over the last n years, all spans in one pass."""
    dated = nav.withColumn("__end", F.max("date").over(whole("amfi_code")))
    point = F.struct("date", "nav")
    starts = [
        F.max(F.when(F.col("date") <= years_before(F.col("__end"), n), point)).alias(f"start_{n}y") for n in years
    ]
    ends = dated.groupBy("amfi_code").agg(F.max(point).alias("finish"), *starts)
    return ends.select("amfi_code", *[(_cagr(n) * 100).alias(f"cagr_{n}y_pct") for n in years])


def _with_drawdown(daily: DataFrame) -> DataFrame:
    """Add the drawdown of each row and, on every row, the trough of its series.

    The running peak keeps the first day it was reached: the largest
    ``(nav, -day)`` pair so far.
    """
    peak = F.max(F.struct(F.col("nav").alias("nav"), (-F.unix_date("date")).alias("day"))).over(so_far("amfi_code"))
    marked = daily.withColumn("__peak", peak).withColumn("__dd", F.col("nav") / F.col("__peak.nav") - 1)
    trough = F.min(F.struct("__dd", "date", "__peak")).over(whole("amfi_code"))
    return marked.withColumn("__trough", trough)


def _drawdown_aggregates() -> list[Column]:
    trough = F.first("__trough")
    recovered = (F.col("date") > F.col("__trough.date")) & (F.col("nav") >= F.col("__trough.__peak.nav"))
    return [
        (trough["__dd"] * 100).alias("max_drawdown_pct"),
        F.date_from_unix_date(-trough["__peak"]["day"]).alias("drawdown_start_date"),
        trough["date"].alias("drawdown_trough_date"),
        F.min(F.when(recovered, F.col("date"))).alias("drawdown_recovery_date"),
    ]


def max_drawdown(nav: DataFrame) -> DataFrame:
    """Deepest fall below the running peak per fund, with its three dates."""
    return _with_drawdown(nav).groupBy("amfi_code").agg(*_drawdown_aggregates())


def max_drawdown_by_slices(nav: DataFrame) -> DataFrame:
    """``max_drawdown`` for series of any length, as a merge of summaries.

    The record of a stretch of prices is its peak, its low and its worst fall, the first of equals each. Of two
    stretches in a row the worst fall is one of theirs, or the later one's low below the earlier one's peak: if a price
    between had risen above that peak, the later record holds a deeper fall. So slices of a series are summed up alone, and
    one record a slice is brought together.
    """
    nav = _one_a_day(nav.select("amfi_code", "date", "nav"), "amfi_code", "nav", None)
    slices = range_slices(nav, ["amfi_code", "date"])
    rows = Window.partitionBy(SLICE, "amfi_code").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    top = F.struct(F.col("nav").alias("nav"), (-F.unix_date("date")).alias("day"))
    marked = slices.withColumn("__peak", F.max(top).over(rows))
    fall = F.struct(
        (F.col("nav") / F.col("__peak.nav") - 1).alias("dd"), F.col("date").alias("date"), (-F.col("__peak.day")).alias("peak_day"), F.col("__peak.nav").alias("peak"))
    records = marked.groupBy(SLICE, "amfi_code").agg(F.max(top).alias("top"), F.min(F.struct("nav", "date")).alias("low"), F.min(fall).alias("worst"))
    before = F.max("top").over(Window.partitionBy("amfi_code").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1))
    across = F.struct(
        (F.col("low.nav") / F.col("__before.nav") - 1).alias("dd"), F.col("low.date").alias("date"), (-F.col("__before.day")).alias("peak_day"), F.col("__before.nav").alias("peak"))
    worst = records.withColumn("__before", before).groupBy("amfi_code").agg(
        F.min(F.least("worst", F.when(F.col("__before").isNotNull(), across))).alias("__trough"))
    recovered = (F.col("date") > F.col("__trough.date")) & (F.col("nav") >= F.col("__trough.peak"))
    ends = slices.join(worst, "amfi_code").where(recovered).groupBy(F.col("amfi_code").alias("__code")).agg(F.min("date").alias("drawdown_recovery_date"))
    return worst.join(ends, F.col("amfi_code") == F.col("__code"), "left").select(
        "amfi_code", (F.col("__trough.dd") * 100).alias("max_drawdown_pct"), F.date_from_unix_date("__trough.peak_day").alias("drawdown_start_date"),
        F.col("__trough.date").alias("drawdown_trough_date"), "drawdown_recovery_date")


def return_risk(daily: DataFrame) -> DataFrame:
    """Annualised return, volatility, Sharpe and Sortino ratio per fund."""
    r = F.col("daily_return")
    return daily.groupBy("amfi_code").agg(*_risk_aggregates(r))


def _risk_aggregates(r: Column) -> list[Column]:
    return [
        (annualised_return(r) * 100).alias("annualized_return_pct"),
        (annualised_volatility(r) * 100).alias("annualized_volatility_pct"),
        (downside_volatility(r) * 100).alias("downside_volatility_pct"),
        excess_over_risk(r, annualised_volatility(r)).alias("sharpe_ratio"),
        excess_over_risk(r, downside_volatility(r)).alias("sortino_ratio"),
    ]


def _return_statistics(r: Column) -> list[Column]:
    return [
        (F.min(r) * 100).alias("min_daily_return_pct"),
        (F.max(r) * 100).alias("max_daily_return_pct"),
        (F.avg(r) * 100).alias("mean_daily_return_pct"),
        (F.stddev_samp(r) * 100).alias("std_daily_return_pct"),
    ]


def return_statistics(daily: DataFrame) -> DataFrame:
    return daily.groupBy("amfi_code").agg(*_return_statistics(F.col("daily_return")))


def alpha_beta(daily: DataFrame, indices: DataFrame, market: str = S.MARKET_INDEX) -> DataFrame:
    """Least-squares line of fund returns on market returns, dates matched."""
    fit = regression(F.col("daily_return"), F.col("market_return"))
    out = _with_market(daily, indices, market).groupBy("amfi_code").agg(*[v.alias(k) for k, v in fit.items()])
    return out.withColumn("alpha_annualized_pct", F.col("alpha_daily") * S.PERIODS_PER_YEAR * 100)


def tracking_error(daily: DataFrame, indices: DataFrame, strict: bool = False) -> DataFrame:
    """Annualised deviation of the return gap to each fund's own index."""
    gap = F.col("daily_return") - F.col("tracked_return")
    return _with_tracked(daily, indices, strict).groupBy("amfi_code").agg(
        F.first("tracking_benchmark").alias("tracking_benchmark"),
        (annualised_volatility(gap) * 100).alias("tracking_error_pct"),
    )


_METRIC_COLUMNS = (
    "amfi_code", "scheme_name", "fund_house", "category", "sub_category", "benchmark", "expense_ratio_pct",
    "start_date", "end_date", "nav_observations", "return_observations", "annualized_return_pct",
    "cagr_1y_pct", "cagr_3y_pct", "cagr_5y_pct", "annualized_volatility_pct", "sharpe_ratio", "sortino_ratio",
    "alpha_daily", "alpha_annualized_pct", "beta", "r_squared", "regression_observations", "max_drawdown_pct",
    "drawdown_start_date", "drawdown_trough_date", "drawdown_recovery_date", "min_daily_return_pct",
    "max_daily_return_pct", "mean_daily_return_pct", "std_daily_return_pct", "tracking_benchmark",
    "tracking_error_pct",
)


def fund_metrics(nav: DataFrame, funds: DataFrame, indices: DataFrame, market: str = S.MARKET_INDEX) -> DataFrame:
    """The full record of every fund, one pass over its prices.

    ``indices`` holds index returns. Fund columns are joined to the finished
    records (one row per fund), except the benchmark name, which decides the
    index each day is compared with.
    """
    daily = daily_returns(nav).join(funds.select("amfi_code", "benchmark"), "amfi_code", "left")
    daily = _with_tracked(_with_market(daily, indices, market), indices)
    daily = _with_drawdown(daily).withColumn("__end", F.max("date").over(whole("amfi_code")))

    r, point = F.col("daily_return"), F.struct("date", "nav")
    fit = regression(r, F.col("market_return"))
    starts = [
        F.max(F.when(F.col("date") <= years_before(F.col("__end"), n), point)).alias(f"start_{n}y")
        for n in (1, 3, 5)
    ]
    records = daily.groupBy("amfi_code").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        F.count("*").alias("nav_observations"), F.count(r).alias("return_observations"),
        *_risk_aggregates(r), *_return_statistics(r), *_drawdown_aggregates(),
        *[v.alias(k) for k, v in fit.items()],
        F.first("tracking_benchmark").alias("tracking_benchmark"),
        (annualised_volatility(r - F.col("tracked_return")) * 100).alias("tracking_error_pct"),
        F.max(point).alias("finish"), *starts,
    )
    records = records.withColumns({
        "alpha_annualized_pct": F.col("alpha_daily") * S.PERIODS_PER_YEAR * 100,
        **{f"cagr_{n}y_pct": _cagr(n) * 100 for n in (1, 3, 5)},
    })
    named = records.join(existing(funds, ("amfi_code", *S.FUND_METADATA)), "amfi_code", "left")
    return existing(named, _METRIC_COLUMNS)


def return_correlation(nav: DataFrame, selected: DataFrame, k: int) -> DataFrame:
    """Correlation of daily returns between ``k`` chosen funds.

    ``selected`` has ``(amfi_code, slot)`` with slots 1..k. Returns are laid out in
    k columns per day and days where any fund is missing are dropped. Each day then
    gives one row per fund holding its own return beside all k: k rows a day, never
    one per pair.
    """
    slots = range(1, k + 1)
    chosen = nav.join(F.broadcast(selected), "amfi_code")
    daily = chosen.withColumn("r", change("nav", "amfi_code"))
    wide = daily.groupBy("date").agg(*[
        F.max(F.when(F.col("slot") == i, F.col("r"))).alias(f"r{i}") for i in slots
    ]).dropna()
    own = F.array(*[F.struct(F.lit(i).alias("slot_a"), F.col(f"r{i}").alias("own")) for i in slots])
    against = wide.select(F.inline(own), *[f"r{i}" for i in slots])
    matrix = against.groupBy("slot_a").agg(*[F.corr("own", f"r{i}").alias(f"c{i}") for i in slots])
    cells = F.array(*[F.struct(F.lit(i).alias("slot_b"), F.col(f"c{i}").alias("correlation")) for i in slots])
    names = selected.select("slot", "amfi_code")
    return (
        matrix.select("slot_a", F.inline(cells))
        .join(F.broadcast(names.toDF("slot_a", "code_a")), "slot_a")
        .join(F.broadcast(names.toDF("slot_b", "code_b")), "slot_b")
        .select("slot_a", "slot_b", "code_a", "code_b", "correlation")
    )


def mean_pairwise(matrix: DataFrame) -> DataFrame:
    """Mean of the cells above the diagonal."""
    return upper_triangle(matrix).agg(F.avg("correlation").alias("mean_correlation"))


def upper_triangle(matrix: DataFrame) -> DataFrame:
    return matrix.where(F.col("slot_a") < F.col("slot_b"))
