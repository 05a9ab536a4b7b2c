"""Weighted ranking of funds, the comparison series and the run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake import schemas as S
from fundlake.functions.calendar import years_before
from fundlake.operators.aggregates import beside
from fundlake.operators.ranking import min_ranks, row_numbers
from fundlake.operators.series import rebase_to_own_start
from fundlake.session import cut_lineage
from fundlake.sources.files import read_table, write_table

ALPHA_BETA_COLUMNS = (
    "amfi_code", "scheme_name", "fund_house", "category", "alpha_daily", "alpha_annualized_pct", "beta",
    "r_squared", "regression_observations",
)


def with_scores(metrics: DataFrame) -> DataFrame:
    """Five min-ranks, their weighted scores and the total.

    A missing metric gets no rank and adds nothing; every fund counts in N.
    """
    ranks = {rank: (metric, up) for metric, rank, up, _ in S.SCORECARD_PARTS.values()}
    ranked = min_ranks(metrics, ranks).withColumn("__n", metrics.select(F.count("*")).scalar().cast("double"))
    scores = {
        f"score_{part}": (F.col("__n") - F.col(rank) + 1) / F.col("__n") * F.lit(weight) * 100
        for part, (_, rank, _, weight) in S.SCORECARD_PARTS.items()
    }
    scored = ranked.withColumns(scores).drop("__n")
    fund_score = F.lit(0.0)
    for name in scores:
        fund_score = fund_score + F.coalesce(F.col(name), F.lit(0.0))
    return scored.withColumn("fund_score", fund_score)


def ranking_order():
    """Best first; code last so that the order is total."""
    best_first = [F.col(c).desc_nulls_last() for c in ("fund_score", "cagr_3y_pct", "sharpe_ratio", "alpha_annualized_pct")]
    return [*best_first, F.col("scheme_name").asc_nulls_last(), F.col("amfi_code").asc()]


def scorecard(metrics: DataFrame) -> DataFrame:
    """Ranked funds, ``fund_rank`` 1 the best.

    Metrics are stored first (one row per fund), as they are used several times.
    """
    return row_numbers(with_scores(cut_lineage(metrics)), ranking_order(), "fund_rank")


def best_funds(ranked: DataFrame, n: int = 5) -> DataFrame:
    return ranked.orderBy("fund_rank").limit(n)


def growth_comparison(ranked: DataFrame, nav: DataFrame, indices: DataFrame, top: int = 5, years: int = 3) -> DataFrame:
    """Growth of 100 over the last years: the best funds against the two indices.

    ``nav`` holds prices by amfi_code and date; names come with the ranking. Only prices of the chosen funds and years are sorted.
    """
    end = nav.select(F.max("date")).scalar()
    recent = (F.col("date") >= years_before(end, years)) & (F.col("date") <= end)
    best = best_funds(ranked, top).select("amfi_code", "scheme_name")
    funds = nav.select("amfi_code", "date", "nav").where(recent & F.col("nav").isNotNull()).join(F.broadcast(best), "amfi_code").select(
        "date", F.col("scheme_name").alias("series_name"), F.col("nav").alias("level"))
    compared = indices.where(recent & F.col("index_name").isin(*S.COMPARISON_INDICES)).select(
        "date", F.col("index_name").alias("series_name"), F.col("close_value").alias("level"))
    based = rebase_to_own_start(funds.unionByName(compared), "series_name", "level")
    return based.select("date", "series_name", "normalized_value")


def exports(metrics: DataFrame, ranked: DataFrame, daily: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Write alpha and beta, the scorecard and the daily returns below ``folder``; gives them as written."""
    parts = {
        "alpha_beta": metrics.select(*ALPHA_BETA_COLUMNS).orderBy(F.desc_nulls_last("alpha_annualized_pct"), "amfi_code"),
        "fund_scorecard": ranked.orderBy("fund_rank"),
        "daily_returns": daily,
    }
    for name, part in parts.items():
        write_table(part, f"{folder}/{name}")
    return {name: read_table(part.sparkSession, f"{folder}/{name}") for name, part in parts.items()}


def run_summary(ranked: DataFrame, daily: DataFrame) -> DataFrame:
    """One row about the run: counts, span, best fund, availability of 5-year growth."""
    funds = ranked.agg(
        F.countDistinct("amfi_code").alias("fund_count"),
        F.min(F.struct("fund_rank", "scheme_name", "fund_score")).alias("best"),
        F.count("cagr_5y_pct").alias("cagr_5y_available_funds"),
    )
    rows = daily.agg(
        F.count("daily_return").alias("daily_return_rows"),
        F.count_if(F.col("daily_return").isNull()).alias("missing_first_return_rows"),
        F.min("date").alias("date_min"), F.max("date").alias("date_max"),
    )
    return beside(funds, rows).select(
        "fund_count", "daily_return_rows", "missing_first_return_rows", "date_min", "date_max",
        F.col("best.scheme_name").alias("top_fund"), F.round("best.fund_score", 4).alias("top_fund_score"),
        "cagr_5y_available_funds",
    )
