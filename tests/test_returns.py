import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fundlake.plans import returns, scorecard
from tests.conftest import by_key

FUNDS = "amfi_code BIGINT, scheme_name STRING, fund_house STRING, category STRING, sub_category STRING, benchmark STRING, expense_ratio_pct DOUBLE"


def indices(spark, day, first, values, name="NIFTY100"):
    start = day(first)
    rows = [(start + dt.timedelta(days=i), name, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date DATE, index_name STRING, close_value DOUBLE")


def test_one_row_series_has_no_figures(prices):
    table = prices({1: ("2024-01-01", [10])})
    risk = returns.return_risk(returns.daily_returns(table)).first()
    assert risk.annualized_return_pct is None and risk.annualized_volatility_pct is None and risk.sharpe_ratio is None
    growth = returns.cagr(table).first()
    assert growth.cagr_1y_pct is None


def test_cagr_needs_a_start_row(prices):
    first = dt.date(2021, 2, 1)
    days = (dt.date(2024, 1, 1) - first).days + 1
    growth = returns.cagr(prices({1: (first.isoformat(), [100 + i for i in range(days)])})).first()
    assert growth.cagr_3y_pct is None and growth.cagr_5y_pct is None
    years = 365 / 365.25
    assert growth.cagr_1y_pct == pytest.approx((((100 + days - 1) / (100 + days - 1 - 365)) ** (1 / years) - 1) * 100)


def test_leap_day_start_is_the_twenty_eighth(prices):
    growth = returns.cagr(prices({1: {"2023-02-27": 50, "2023-02-28": 80, "2024-02-29": 100}})).first()
    years = (dt.date(2024, 2, 29) - dt.date(2023, 2, 28)).days / 365.25
    assert growth.cagr_1y_pct == pytest.approx(((100 / 80) ** (1 / years) - 1) * 100)


def test_no_loss_no_sortino(prices):
    risk = returns.return_risk(returns.daily_returns(prices({1: ("2024-01-01", [10, 11, 13, 14])}))).first()
    assert risk.sortino_ratio is None and risk.sharpe_ratio is not None


def test_constant_price(prices, day):
    table = prices({1: ("2024-01-01", [10, 10, 10])})
    assert returns.return_risk(returns.daily_returns(table)).first().sharpe_ratio is None
    fall = returns.max_drawdown(table).first()
    assert fall.max_drawdown_pct == 0.0
    assert fall.drawdown_start_date == fall.drawdown_trough_date == day("2024-01-01")
    assert fall.drawdown_recovery_date == day("2024-01-02")


def test_drawdown_dates(prices, day):
    table = prices({
        1: ("2024-01-01", [10, 12, 12, 6, 9, 6, 12, 13]),
        2: ("2024-01-01", [10, 5, 6]),
    })
    falls = by_key(returns.max_drawdown(table))
    assert falls[1].max_drawdown_pct == -50.0
    assert falls[1].drawdown_start_date == day("2024-01-02")
    assert falls[1].drawdown_trough_date == day("2024-01-04")
    assert falls[1].drawdown_recovery_date == day("2024-01-07")
    assert falls[2].drawdown_recovery_date is None


def test_first_duplicate_day_wins(spark, day):
    rows = [(1, day("2024-01-01"), 10.0, 0), (1, day("2024-01-02"), 20.0, 1), (1, day("2024-01-02"), 99.0, 2)]
    daily = returns.daily_returns(spark.createDataFrame(rows, "amfi_code BIGINT, date DATE, nav DOUBLE, seq INT"), arrival="seq")
    assert [r.daily_return for r in daily.orderBy("date").collect()] == [None, 1.0]


@pytest.fixture(scope="module")
def market(spark, prices, day):
    """Three funds, two indices and a brute-force pandas copy."""
    rng = random.Random(11)

    def walk(n):
        level, out = 100.0, []
        for _ in range(n):
            level *= 1 + rng.gauss(0.0004, 0.01)
            out.append(level)
        return out

    series = {1: walk(1500), 2: walk(1200), 3: walk(40)}
    nav = prices({k: ("2020-01-01", v) for k, v in series.items()})
    nifty = walk(1500)
    idx = indices(spark, day, "2020-01-01", nifty).unionByName(indices(spark, day, "2020-01-01", walk(1500), "NIFTY50"))
    funds = spark.createDataFrame([
        (1, "Alpha", "H", "Equity", "Large", "NIFTY 50 TRI", 1.0), (2, "Beta", "H", "Equity", "Mid", "NIFTY 100 TRI", 0.5),
        (3, "Gamma", "H", "Debt", "Gilt", "Crisil Gilt", 2.0)], FUNDS)
    return nav, idx, funds, series, nifty


def test_metrics_match_brute_force(market):
    nav, idx, funds, series, nifty = market
    got = by_key(returns.fund_metrics(nav, funds, returns.benchmark_returns(idx)))
    x_all = pd.Series(nifty).pct_change()
    for code, values in series.items():
        v = pd.Series(values)
        r = v.pct_change()
        row = got[code]
        ann = (1 + r.mean()) ** 252 - 1
        vol = r.std() * np.sqrt(252)
        assert row.nav_observations == len(v) and row.return_observations == len(v) - 1
        assert row.annualized_return_pct == pytest.approx(ann * 100)
        assert row.sharpe_ratio == pytest.approx((ann - 0.065) / vol)
        assert row.sortino_ratio == pytest.approx((ann - 0.065) / (r[r < 0].std() * np.sqrt(252)))
        assert row.max_drawdown_pct == pytest.approx((v / v.cummax() - 1).min() * 100)
        beta, alpha = np.polyfit(x_all[1:len(v)], r[1:], 1)
        assert row.beta == pytest.approx(beta) and row.alpha_annualized_pct == pytest.approx(alpha * 252 * 100)
        assert row.r_squared == pytest.approx(np.corrcoef(x_all[1:len(v)], r[1:])[0, 1] ** 2)
    assert got[2].tracking_benchmark == "NIFTY100"
    gap = pd.Series(series[2]).pct_change() - x_all[:1200]
    assert got[2].tracking_error_pct == pytest.approx(gap.std() * np.sqrt(252) * 100)
    assert got[3].tracking_benchmark == "CRISIL_GILT" and got[3].tracking_error_pct is None
    assert got[1].cagr_3y_pct is not None and got[3].cagr_1y_pct is None


def test_single_metric_functions_agree_with_the_record(market):
    nav, idx, funds, _, _ = market
    idx_returns = returns.benchmark_returns(idx)
    record = by_key(returns.fund_metrics(nav, funds, idx_returns))
    named = returns.daily_returns(nav, funds)
    for parts in (returns.cagr(nav), returns.max_drawdown(nav), returns.alpha_beta(named, idx_returns),
                  returns.tracking_error(named, idx_returns), returns.return_statistics(named)):
        for row in parts.collect():
            for column in parts.columns:
                value = record[row.amfi_code][column]
                assert row[column] == (pytest.approx(value) if isinstance(value, float) else value)


def test_repeated_and_missing_prices_change_nothing(market):
    nav, idx, funds, _, _ = market
    clean = by_key(returns.fund_metrics(nav, funds, returns.benchmark_returns(idx)))
    more_nav = nav.union(nav.withColumn("nav", F.col("nav") + 5)).union(nav.limit(3).withColumn("nav", F.lit(None).cast("double")))
    more_idx = idx.union(idx.withColumn("close_value", F.col("close_value") + 7))
    assert by_key(returns.fund_metrics(more_nav, funds, returns.benchmark_returns(more_idx))) == clean


def test_fund_series_share_one_exchange(market, spark, tmp_path):
    nav, idx, funds, _, _ = market
    for name, table in (("nav", nav), ("idx", idx), ("funds", funds)):
        table.write.parquet(f"{tmp_path}/{name}")
    nav, idx, funds = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("nav", "idx", "funds"))
    plan = returns.fund_metrics(nav, funds, returns.benchmark_returns(idx))._jdf.queryExecution().executedPlan().toString()
    # Beside the one by (fund, day) that leaves one price a day, prices are moved once, by fund; indices are small files.
    assert plan.count("Exchange hashpartitioning(amfi_code") == 1
    assert "Exchange hashpartitioning(date" not in plan and "BroadcastHashJoin [date" in plan


METRICS = ("amfi_code BIGINT, scheme_name STRING, expense_ratio_pct DOUBLE, cagr_3y_pct DOUBLE, cagr_5y_pct DOUBLE, "
           "sharpe_ratio DOUBLE, alpha_annualized_pct DOUBLE, max_drawdown_pct DOUBLE")
RECORDS = [
    (1, "B", 1.0, 10.0, None, 1.0, 5.0, -10.0), (2, "A", 1.0, 10.0, None, 1.0, 5.0, -10.0),
    (3, "C", 0.5, None, None, 2.0, 1.0, -20.0), (4, "D", 2.0, 12.0, None, 0.5, 9.0, -5.0)]


def test_scorecard_ranks_and_scores(spark):
    table = spark.createDataFrame(RECORDS, METRICS)
    rows = by_key(scorecard.scorecard(table))
    assert rows[3].rank_3y_return is None and rows[3].score_3y_return is None
    assert (rows[1].rank_3y_return, rows[2].rank_3y_return, rows[4].rank_3y_return) == (2, 2, 1)
    assert rows[1].score_3y_return == pytest.approx((4 - 2 + 1) / 4 * 30)
    assert rows[3].fund_score == pytest.approx(25 + (4 - 4 + 1) / 4 * 20 + 15 + (4 - 4 + 1) / 4 * 10)
    assert rows[2].fund_rank < rows[1].fund_rank  # equal figures, name decides


def test_missing_metrics_count_in_n(spark):
    table = spark.createDataFrame(RECORDS, METRICS)
    rows = by_key(scorecard.with_scores(table))
    assert {round(r.score_3y_return / (len(RECORDS) - r.rank_3y_return + 1), 9) for r in rows.values() if r.rank_3y_return} == {round(30 / len(RECORDS), 9)}


def test_correlation_uses_complete_days(prices, spark):
    table = prices({1: ("2024-01-01", [1, 2, 3, 5, 4]), 2: ("2024-01-02", [10, 11, 9, 12])})
    chosen = spark.createDataFrame([(1, 1), (2, 2)], "amfi_code BIGINT, slot INT")
    matrix = {(r.code_a, r.code_b): r.correlation for r in returns.return_correlation(table, chosen, 2).collect()}
    a = pd.Series([1, 2, 3, 5, 4]).pct_change()[2:].to_numpy()
    b = pd.Series([10, 11, 9, 12]).pct_change()[1:].to_numpy()
    assert matrix[(1, 2)] == pytest.approx(np.corrcoef(a, b)[0, 1]) and matrix[(1, 1)] == pytest.approx(1.0)
    assert returns.mean_pairwise(returns.return_correlation(table, chosen, 2)).first()[0] == pytest.approx(matrix[(1, 2)])


def test_growth_comparison_starts_at_hundred(market):
    nav, idx, funds, _, _ = market
    ranked = scorecard.scorecard(returns.fund_metrics(nav, funds, returns.benchmark_returns(idx)))
    out = scorecard.growth_comparison(ranked, returns.daily_returns(nav, funds), idx, top=2)
    first = out.groupBy("series_name").agg(F.min_by("normalized_value", "date").alias("v")).collect()
    assert {r.series_name for r in first} >= {"NIFTY50", "NIFTY100"} and all(r.v == 100.0 for r in first)
    assert scorecard.run_summary(ranked, returns.daily_returns(nav)).first().fund_count == 3


def test_scores_of_forty_funds(spark):
    """Rank r of n funds earns (n - r + 1) / n of a part's weight; weights add up to 100."""
    n = 40
    rows = [(k, f"f{k:02d}", float(k), float(n - k), None, float(n - k), float(n - k), float(-k)) for k in range(n)]
    got = by_key(scorecard.scorecard(spark.createDataFrame(rows, METRICS)))
    assert got[0].fund_rank == 1 and got[0].fund_score == pytest.approx(100.0) and got[n - 1].fund_rank == n
    assert got[n - 1].fund_score == pytest.approx(100 / n)
