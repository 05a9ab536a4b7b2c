"""Checks for time series, fund metrics, cleaning, warehouse, quality, reports, result sets."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.checks_basic import _SUMMARY_SQL
from contract.checks_relational import _GRID_SQL, _MATRIX
from contract.registry import CHECKS, check
from contract.tables import Tables
from fundlake import schemas as S
from fundlake.operators import series
from fundlake.plans import cleaning, explore, publication, quality, reporting, returns, scorecard, warehouse
from fundlake.session import brief_shuffles, scratch_path
from fundlake.sources import files

C = F.col

# --- K: time series ---------------------------------------------------------------------
check("k1_gap_fill", lambda t: t.x_nav, "SELECT * FROM {x_nav}")
check("k2_rebase_first_day", lambda t: series.rebase_to_first_day(t.x_nav, "amfi_code", "nav"), "SELECT * FROM {x_indexed}", {"indexed": 9})
check("k3_rebase_own_start", lambda t: series.rebase_to_own_start(t.x_nav, "amfi_code", "nav"),
      "SELECT *, nav / first_value(nav) OVER (PARTITION BY amfi_code ORDER BY date) * 100 AS normalized_value FROM {x_nav}", {"normalized_value": 9})
check("k4_average_indexed", lambda t: explore.average_indexed_nav(t.x_nav), "SELECT * FROM {x_avg_indexed}", {"avg_indexed_nav": 8})
_CATEGORY_INDEXED = """
SELECT m.date, m.category, m.v / b.v * 100 AS indexed_nav
FROM (SELECT date, category, avg(nav) AS v FROM {x_nav} JOIN {x_funds} USING (amfi_code) GROUP BY ALL) m
LEFT JOIN (SELECT category, avg(nav) AS v FROM {x_nav} JOIN {x_funds} USING (amfi_code) WHERE date = (SELECT min(date) FROM {x_nav}) GROUP BY category) b USING (category)"""
check("k5_category_indexed", lambda t: explore.category_indexed_nav(t.x_nav, t.x_funds), _CATEGORY_INDEXED, {"indexed_nav": 8})
_WINDOW = ("1998-07-01", "1998-12-31")
check("k6_local_low", lambda t: explore.focus_low(explore.average_indexed_nav(t.x_nav), *_WINDOW), """
SELECT date, avg_indexed_nav FROM {x_avg_indexed} WHERE date BETWEEN DATE '1998-07-01' AND DATE '1998-12-31' ORDER BY avg_indexed_nav, date LIMIT 1""", {"avg_indexed_nav": 8})
check("k7_daily_returns", lambda t: t.x_returns_named, """
SELECT r.*, f.scheme_name, f.fund_house, f.category, f.sub_category, f.benchmark, f.expense_ratio_pct
FROM {x_returns} r LEFT JOIN {x_funds} f USING (amfi_code)""", {"daily_return": 9})
check("k8_benchmark_returns", lambda t: t.x_index_returns, "SELECT * FROM {x_index_returns}", {"benchmark_return": 9})
check("k9_growth", lambda t: series.growth(t.x_sip, "sip_inflow_crore", "month"), """
SELECT a AS first_value, b AS last_value, b - a AS growth_abs, (b / a - 1) * 100 AS growth_pct
FROM (SELECT arg_min(sip_inflow_crore, month) AS a, arg_max(sip_inflow_crore, month) AS b FROM {x_sip}) t""", ["growth_pct"])
check("k10_growth_comparison", lambda t: scorecard.growth_comparison(t.scorecard(), t.x_nav, t.x_index), """
SELECT date, series_name, level / first_value(level) OVER (PARTITION BY series_name ORDER BY date) * 100 AS normalized_value FROM (
  SELECT n.date, s.scheme_name AS series_name, n.nav AS level FROM {x_nav} n JOIN (SELECT amfi_code, scheme_name FROM {x_scorecard} WHERE fund_rank <= 5) s USING (amfi_code)
  UNION ALL SELECT date, index_name, close_value FROM {x_index} WHERE index_name IN ('NIFTY50', 'NIFTY100')) u
WHERE date >= (SELECT CAST(max(date) - INTERVAL 3 YEAR AS DATE) FROM {x_nav}) AND date <= (SELECT max(date) FROM {x_nav})""", {"normalized_value": 8})

_SIP_GROWTH = """
WITH m AS (SELECT CAST(year(transaction_date) AS INT) AS year, CAST(month(transaction_date) AS INT) AS month,
  CAST(sum(amount_inr) AS BIGINT) AS sip_amount, count(*) AS sip_txn_count FROM {x_txn} WHERE transaction_type = 'SIP' GROUP BY ALL)
SELECT a.*, (a.sip_amount - b.sip_amount) * CAST(100 AS DOUBLE) / nullif(b.sip_amount, 0) AS yoy_sip_amount_pct,
  (a.sip_txn_count - b.sip_txn_count) * CAST(100 AS DOUBLE) / nullif(b.sip_txn_count, 0) AS yoy_sip_count_pct
FROM m a LEFT JOIN m b ON b.year + 1 = a.year AND b.month = a.month"""
_NET_FLOW = """
WITH m AS (SELECT CAST(year(transaction_date) AS INT) AS year, CAST(month(transaction_date) AS INT) AS month,
  CAST(coalesce(sum(amount_inr) FILTER (transaction_type <> 'Redemption'), 0) AS BIGINT) AS gross_inflow,
  CAST(coalesce(sum(amount_inr) FILTER (transaction_type = 'Redemption'), 0) AS BIGINT) AS redemption FROM {x_txn} GROUP BY ALL)
SELECT *, gross_inflow - redemption AS net_flow, CAST(100 AS DOUBLE) * (gross_inflow - redemption - lag(gross_inflow - redemption) OVER o)
  / nullif(lag(gross_inflow - redemption) OVER o, 0) AS mom_net_flow_change_pct FROM m WINDOW o AS (ORDER BY year, month)"""
check("k11_year_over_year", lambda t: reporting.sip_growth(t.star()), _SIP_GROWTH, {"yoy_sip_amount_pct": 2, "yoy_sip_count_pct": 2})
check("k12_month_over_month", lambda t: reporting.net_flow(t.star()), _NET_FLOW, {"mom_net_flow_change_pct": 2})

# --- M: performance and risk ------------------------------------------------------------
check("m1_cagr", lambda t: returns.cagr(t.x_nav), "SELECT * FROM {x_cagr}", {f"cagr_{n}y_pct": 8 for n in (1, 3, 5)})


def _risk(*columns: str):
    return lambda t: returns.return_risk(t.x_returns).select("amfi_code", *columns)


check("m2_annualised_return", _risk("annualized_return_pct"), "SELECT amfi_code, ann * 100 AS annualized_return_pct FROM {x_risk}", {"annualized_return_pct": 5})
check("m3_annualised_volatility", _risk("annualized_volatility_pct"), "SELECT amfi_code, vol * 100 AS annualized_volatility_pct FROM {x_risk}", ["annualized_volatility_pct"])
check("m4_downside_volatility", _risk("downside_volatility_pct"), "SELECT amfi_code, downvol * 100 AS downside_volatility_pct FROM {x_risk}", ["downside_volatility_pct"])
check("m5_sharpe", _risk("sharpe_ratio"), "SELECT amfi_code, CASE WHEN vol > 0 THEN (ann - 0.065) / vol END AS sharpe_ratio FROM {x_risk}", ["sharpe_ratio"])
check("m6_sortino", _risk("sortino_ratio"), "SELECT amfi_code, CASE WHEN downvol > 0 THEN (ann - 0.065) / downvol END AS sortino_ratio FROM {x_risk}", ["sortino_ratio"])
check("m7_alpha_beta", lambda t: returns.alpha_beta(t.x_returns, t.x_index_returns), "SELECT * FROM {x_alpha}",
      {"beta": 8, "alpha_daily": 9, "r_squared": 9, "alpha_annualized_pct": 6})
check("m8_max_drawdown", lambda t: returns.max_drawdown(t.x_nav), "SELECT * FROM {x_drawdown}", {"max_drawdown_pct": 9})
check("m9_return_statistics", lambda t: returns.return_statistics(t.x_returns),
      "SELECT amfi_code, min_daily_return_pct, max_daily_return_pct, mean_daily_return_pct, std_daily_return_pct FROM {x_risk}",
      {f"{n}_daily_return_pct": 8 for n in ("min", "max", "mean", "std")})
_METRIC_DIGITS = {
    "annualized_return_pct": 5, "cagr_1y_pct": 8, "cagr_3y_pct": 8, "cagr_5y_pct": 8, "annualized_volatility_pct": 6,
    "sharpe_ratio": 6, "sortino_ratio": 6, "alpha_daily": 9, "alpha_annualized_pct": 6, "beta": 8, "r_squared": 9,
    "max_drawdown_pct": 8, "min_daily_return_pct": 8, "max_daily_return_pct": 8, "mean_daily_return_pct": 8,
    "std_daily_return_pct": 8, "tracking_error_pct": 6,
}
check("m10_fund_metrics", lambda t: t.x_metrics, "SELECT * FROM {x_metrics}", _METRIC_DIGITS)
check("m11_tracking_error", lambda t: returns.tracking_error(t.x_returns_named, t.x_index_returns), "SELECT * FROM {x_tracking}", ["tracking_error_pct"])
_SCORE_COLUMNS = [f"score_{p}" for p in S.SCORECARD_PARTS] + ["fund_score"]
_RANK_COLUMNS = [p[1] for p in S.SCORECARD_PARTS.values()]
check("m12_scores", lambda t: scorecard.scorecard(t.x_metrics).select("amfi_code", *_RANK_COLUMNS, *_SCORE_COLUMNS),
      f"SELECT amfi_code, {', '.join(_RANK_COLUMNS + _SCORE_COLUMNS)} FROM {{x_scores}}", {c: 8 for c in _SCORE_COLUMNS})
check("m13_final_ranking", lambda t: scorecard.scorecard(t.x_metrics), "SELECT * FROM {x_scorecard}", _METRIC_DIGITS | {c: 8 for c in _SCORE_COLUMNS})
check("m14_return_correlation", lambda t: returns.return_correlation(t.x_nav, explore.largest_by_aum(t.x_perf), 10).select("code_a", "code_b", "correlation"),
      "SELECT code_a, code_b, correlation FROM {x_corr}", {"correlation": 9})
check("m15_mean_pairwise", lambda t: returns.mean_pairwise(returns.return_correlation(t.x_nav, explore.largest_by_aum(t.x_perf), 10)),
      "SELECT avg(correlation) AS mean_correlation FROM {x_corr} WHERE slot_a < slot_b", {"mean_correlation": 9})
check("m16_run_summary", lambda t: scorecard.run_summary(t.scorecard(), t.x_returns), _SUMMARY_SQL, {"top_fund_score": 4})

# --- C: cleaning pipelines --------------------------------------------------------------
_LAST = "row_number() OVER (PARTITION BY {keys} ORDER BY ingest_seq DESC) AS pos"


def _cleaned(dataset: str, table: str):
    return lambda t: cleaning.clean(dataset, getattr(t, table))


def _clean_sql(columns: str, table: str, where: str, keys: str) -> str:
    """Typed columns, rules, then keep-last, written independently of the pipelines."""
    return (f"SELECT * EXCLUDE (pos, ingest_seq) FROM (SELECT *, {_LAST.format(keys=keys)} FROM "
            f"(SELECT {columns}, ingest_seq FROM {{{table}}}) typed WHERE {where}) kept WHERE pos = 1")


_FUNDS_SQL = _clean_sql(
    "CAST(try_cast(trim(amfi_code) AS DOUBLE) AS BIGINT) AS amfi_code, trim(fund_house) AS fund_house, scheme_name, trim(category) AS category, "
    "sub_category, trim(plan) AS plan, try_cast(launch_date AS DATE) AS launch_date, benchmark, try_cast(expense_ratio_pct AS DOUBLE) AS expense_ratio_pct, "
    "try_cast(exit_load_pct AS DOUBLE) AS exit_load_pct, try_cast(min_sip_amount AS BIGINT) AS min_sip_amount, "
    "CAST(trunc(try_cast(min_lumpsum_amount AS DOUBLE)) AS BIGINT) AS min_lumpsum_amount, fund_manager, risk_category, sebi_category_code",
    "r_funds", "amfi_code IS NOT NULL AND launch_date IS NOT NULL AND expense_ratio_pct BETWEEN CAST(0.1 AS DOUBLE) AND CAST(2.5 AS DOUBLE) "
    "AND min_sip_amount > 0 AND min_lumpsum_amount > 0 AND plan IN ('Direct', 'Regular')", "amfi_code")
check("c1_clean_fund_master", _cleaned("fund_master", "r_funds"), _FUNDS_SQL)
_NAV_SQL = """
WITH daily AS (SELECT CAST(amfi_code AS BIGINT) AS amfi_code, CAST(date AS DATE) AS date, try_cast(nav AS DOUBLE) AS nav FROM (
    SELECT *, row_number() OVER (PARTITION BY amfi_code, date ORDER BY ingest_seq DESC) AS pos FROM {r_nav} WHERE try_cast(date AS DATE) IS NOT NULL) d
  WHERE pos = 1 AND try_cast(nav AS DOUBLE) > 0),
spine AS (SELECT amfi_code, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS day FROM daily GROUP BY amfi_code)
SELECT s.amfi_code, CAST(s.day AS DATE) AS date, d.nav FROM spine s ASOF JOIN daily d ON d.amfi_code = s.amfi_code AND CAST(s.day AS DATE) >= d.date"""
check("c2_clean_nav_history", _cleaned("nav_history", "r_nav"), _NAV_SQL)
_AUM_SQL = _clean_sql(
    "try_cast(date AS DATE) AS date, trim(fund_house) AS fund_house, try_cast(aum_lakh_crore AS DOUBLE) AS aum_lakh_crore, "
    "CAST(trunc(try_cast(aum_crore AS DOUBLE)) AS BIGINT) AS aum_crore, try_cast(num_schemes AS BIGINT) AS num_schemes",
    "r_aum", "date IS NOT NULL AND aum_lakh_crore > 0 AND aum_crore > 0 AND num_schemes > 0", "date, fund_house")
check("c3_clean_aum", _cleaned("aum_by_fund_house", "r_aum"), _AUM_SQL)
_SIP_SQL = _clean_sql(
    "try_cast(month || '-01' AS DATE) AS month, CAST(trunc(try_cast(sip_inflow_crore AS DOUBLE)) AS BIGINT) AS sip_inflow_crore, "
    "try_cast(active_sip_accounts_crore AS DOUBLE) AS active_sip_accounts_crore, try_cast(new_sip_accounts_lakh AS DOUBLE) AS new_sip_accounts_lakh, "
    "try_cast(sip_aum_lakh_crore AS DOUBLE) AS sip_aum_lakh_crore, try_cast(yoy_growth_pct AS DOUBLE) AS yoy_growth_pct",
    "r_sip", "month IS NOT NULL AND sip_inflow_crore > 0 AND active_sip_accounts_crore > 0 AND new_sip_accounts_lakh > 0 AND sip_aum_lakh_crore > 0", "month")
check("c4_clean_sip_inflows", _cleaned("monthly_sip_inflows", "r_sip"), _SIP_SQL)
_CATEGORY_SQL = _clean_sql(
    "try_cast(month || '-01' AS DATE) AS month, trim(category) AS category, try_cast(net_inflow_crore AS DOUBLE) AS net_inflow_crore",
    "r_category", "month IS NOT NULL AND net_inflow_crore IS NOT NULL", "month, category")
check("c5_clean_category_inflows", _cleaned("category_inflows", "r_category"), _CATEGORY_SQL)
_FOLIO_COLUMNS = S.INDUSTRY_FOLIO_COUNT[1:]
_FOLIO_SQL = _clean_sql(
    "try_cast(month || '-01' AS DATE) AS month, " + ", ".join(f"try_cast({c} AS DOUBLE) AS {c}" for c in _FOLIO_COLUMNS),
    "r_folio", "month IS NOT NULL AND " + " AND ".join(f"{c} > 0" for c in _FOLIO_COLUMNS), "month")
check("c6_clean_folio_count", _cleaned("industry_folio_count", "r_folio"), _FOLIO_SQL)
_FLAG_SQL = """concat_ws(';', CASE WHEN sharpe_ratio > 3 THEN 'high_sharpe_ratio' END,
  CASE WHEN abs(sharpe_ratio - return_3yr_pct) <= 1e-8 + 1e-5 * abs(return_3yr_pct) THEN 'sharpe_matches_return_3yr' END,
  CASE WHEN sortino_ratio > 5 THEN 'high_sortino_ratio' END, CASE WHEN max_drawdown_pct > 0 THEN 'positive_max_drawdown' END,
  CASE WHEN abs(return_1yr_pct) > 50 THEN 'extreme_return_1yr' END, CASE WHEN beta < 0 OR beta > 2 THEN 'beta_out_of_range' END,
  CASE WHEN morningstar_rating < 1 OR morningstar_rating > 5 THEN 'invalid_morningstar_rating' END)"""
_PERF_TYPED = _clean_sql(
    "try_cast(amfi_code AS BIGINT) AS amfi_code, scheme_name, fund_house, category, plan, "
    + ", ".join(f"try_cast({c} AS DOUBLE) AS {c}" for c in S.PERFORMANCE_METRICS) + ", risk_grade",
    "r_perf", "amfi_code IS NOT NULL AND " + " AND ".join(f"{c} IS NOT NULL" for c in S.PERFORMANCE_METRICS), "amfi_code")
_PERF_SQL = (f"SELECT * REPLACE (CAST(trunc(aum_crore) AS BIGINT) AS aum_crore, CAST(morningstar_rating AS BIGINT) AS morningstar_rating), "
             f"{_FLAG_SQL} AS anomaly_flag FROM ({_PERF_TYPED}) p")
check("c7_clean_performance", _cleaned("scheme_performance", "r_perf"), _PERF_SQL)
_TXN_SQL = """
SELECT DISTINCT investor_id, CAST(transaction_date AS DATE) AS transaction_date, CAST(amfi_code AS BIGINT) AS amfi_code,
  CASE ingest_seq % 7 WHEN 0 THEN 'SIP' WHEN 1 THEN 'SIP' WHEN 3 THEN 'Redemption' ELSE 'Lumpsum' END AS transaction_type,
  CAST(trunc(CAST(amount_inr AS DOUBLE)) AS BIGINT) AS amount_inr, state, city, city_tier, age_group, gender,
  CAST(annual_income_lakh AS DOUBLE) AS annual_income_lakh, payment_mode, CASE WHEN kyc_status = 'pending' THEN 'Pending' ELSE 'Verified' END AS kyc_status
FROM {r_txn} WHERE ingest_seq % 7 NOT IN (4, 5) AND ingest_seq % 11 > 1 AND ingest_seq % 13 <> 0 AND ingest_seq % 19 <> 0"""
check("c8_clean_transactions", _cleaned("investor_transactions", "r_txn"), _TXN_SQL)
_HOLDINGS_SQL = _clean_sql(
    "try_cast(amfi_code AS BIGINT) AS amfi_code, trim(stock_symbol) AS stock_symbol, stock_name, trim(sector) AS sector, "
    "try_cast(weight_pct AS DOUBLE) AS weight_pct, try_cast(market_value_cr AS DOUBLE) AS market_value_cr, "
    "try_cast(current_price_inr AS DOUBLE) AS current_price_inr, try_cast(portfolio_date AS DATE) AS portfolio_date",
    "r_holdings", "amfi_code IS NOT NULL AND portfolio_date IS NOT NULL AND weight_pct > 0 AND market_value_cr > 0 AND current_price_inr > 0",
    "amfi_code, portfolio_date, stock_symbol")
check("c9_clean_holdings", _cleaned("portfolio_holdings", "r_holdings"), _HOLDINGS_SQL)
_INDEX_SQL = _clean_sql(
    "try_cast(date AS DATE) AS date, trim(index_name) AS index_name, try_cast(close_value AS DOUBLE) AS close_value",
    "r_index", "date IS NOT NULL AND close_value > 0", "date, index_name")
check("c10_clean_benchmark_indices", _cleaned("benchmark_indices", "r_index"), _INDEX_SQL)
check("c11_anomaly_flags", lambda t: t.x_flagged, "SELECT * FROM {x_flagged}")

_RAW = {
    "fund_master": "r_funds", "nav_history": "r_nav", "aum_by_fund_house": "r_aum", "monthly_sip_inflows": "r_sip",
    "category_inflows": "r_category", "industry_folio_count": "r_folio", "scheme_performance": "r_perf",
    "investor_transactions": "r_txn", "portfolio_holdings": "r_holdings", "benchmark_indices": "r_index",
}
_CLEAN_SQL = {
    "fund_master": _FUNDS_SQL, "nav_history": _NAV_SQL, "aum_by_fund_house": _AUM_SQL, "monthly_sip_inflows": _SIP_SQL,
    "category_inflows": _CATEGORY_SQL, "industry_folio_count": _FOLIO_SQL, "scheme_performance": _PERF_SQL,
    "investor_transactions": _TXN_SQL, "portfolio_holdings": _HOLDINGS_SQL, "benchmark_indices": _INDEX_SQL,
}

#: One row an order, whose key is the arrival number: sorted by it without an exchange where the orders are kept in its order.
_BY_ORDER = ("nav_history", "aum_by_fund_house", "monthly_sip_inflows", "category_inflows", "industry_folio_count", "benchmark_indices")
#: Landed one after the other: their sorts exchange most of what is written, and one such exchange at a time is on disk.
_ALONE = ("portfolio_holdings", "investor_transactions")


def _land(t: Tables, datasets) -> str:
    """Write raw tables as the CSV folder the runners read, rows in arrival order."""
    folder = scratch_path(t.spark, "raw")

    def land(dataset: str, made: Tables) -> None:
        step, rows = cleaning.PIPELINES[dataset], getattr(made, _RAW[dataset])
        ordered = rows.orderBy("ingest_seq").select(*step.columns) if dataset in _BY_ORDER else files.in_order(rows, step.columns, "ingest_seq")
        files.write_csv(ordered, f"{folder}/{step.file}", compression="gzip")

    with brief_shuffles(t.spark):
        if len(datasets) > 1:
            t = t.with_stored("x_orders")
            together = [dataset for dataset in datasets if dataset not in _ALONE]
            with t.with_ordered("x_orders", "o_orderkey", map(_RAW.get, together)) as made, ThreadPoolExecutor(cleaning.AT_ONCE) as pool:
                list(pool.map(land, together, [made] * len(together)))
            datasets = [dataset for dataset in _ALONE if dataset in datasets]
        for dataset in datasets:
            land(dataset, t)
    return folder


def _run_all(t: Tables) -> DataFrame:
    return cleaning.run_all(t.spark, _land(t, _RAW), scratch_path(t.spark, "clean"))


check("c12_run_all", _run_all, " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, (SELECT count(*) FROM {{{table}}}) AS raw_rows, (SELECT count(*) FROM ({_CLEAN_SQL[d]}) q) AS clean_rows"
    for d, table in _RAW.items()))


def _run_one(dataset: str):
    def run(t: Tables) -> DataFrame:
        step, out = cleaning.PIPELINES[dataset], scratch_path(t.spark, "clean")
        cleaning.run_one(t.spark, dataset, _land(t, [dataset]), out)
        back = files.read_csv(t.spark, f"{out}/{step.file}", step.output).drop("ingest_seq")
        return back
    return run


check("c13_run_one_nav", lambda t: _run_one("nav_history")(t).select(C("amfi_code").cast("long").alias("amfi_code"), C("date").cast("date").alias("date"), C("nav").cast("double").alias("nav")), _NAV_SQL)


def _typed(dataset: str, like: str):
    """A runner's file with the types of the pipeline's result, every column."""
    def run(t: Tables) -> DataFrame:
        types = dict(cleaning.clean(dataset, getattr(t, like)).dtypes)
        back = _run_one(dataset)(t)
        return back.select(*[C(name).cast(types[name]).alias(name) for name in types])
    return run


check("c13_run_one_transactions", _typed("investor_transactions", "r_txn"), _TXN_SQL)
check("c13_run_one_performance", _typed("scheme_performance", "r_perf"), f"SELECT * REPLACE (nullif(anomaly_flag, '') AS anomaly_flag) FROM ({_PERF_SQL}) q")

# --- W10-W14: warehouse -----------------------------------------------------------------
check("w10_dim_fund", lambda t: warehouse.dim_fund(t.x_funds), "SELECT * FROM {s_dim_fund}")
check("w11_dim_date", lambda t: warehouse.dim_date(t.x_funds, t.x_nav, t.x_txn, t.x_aum), "SELECT * FROM {s_dim_date}")
check("w12_fact_nav", lambda t: t.star()["fact_nav"], "SELECT * FROM {s_fact_nav}")
check("w12_fact_transactions", lambda t: t.star()["fact_transactions"].drop("transaction_key"), "SELECT * FROM {s_fact_txn}")
check("w12_fact_performance", lambda t: t.star()["fact_performance"], "SELECT * FROM {s_fact_perf}")
check("w12_fact_aum", lambda t: t.star()["fact_aum"], "SELECT * FROM {s_fact_aum}")


def _broken_rules(t: Tables) -> DataFrame:
    return warehouse.check_constraints(t.star()).where(C("violations") > 0)


check("w13_constraints", _broken_rules, """
SELECT * FROM (SELECT 'fact_transactions' AS "table", 'not null: gender' AS rule, count(*) AS violations FROM {x_txn} WHERE gender IS NULL
UNION ALL SELECT 'fact_performance', 'check: morningstar_rating', count(*) FROM {s_fact_perf} WHERE morningstar_rating NOT BETWEEN 1 AND 5) v WHERE violations > 0""")


def _row_counts(t: Tables) -> DataFrame:
    sources = {"dim_fund": t.x_funds, "fact_nav": t.x_nav, "fact_aum": t.x_aum, "fact_performance": t.x_flagged, "fact_transactions": t.x_txn}
    return warehouse.compare_row_counts(sources, t.star())


check("w14_row_counts", _row_counts, " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {{{src}}}) AS source_rows, (SELECT count(*) FROM {{{src}}}) AS table_rows, 'OK' AS status"
    for name, src in {"dim_fund": "x_funds", "fact_nav": "x_nav", "fact_aum": "x_aum", "fact_performance": "x_perf", "fact_transactions": "x_txn"}.items()))



def _publish(t: Tables, root: str, aum: DataFrame | None = None) -> str:
    return publication.publish(t.spark, root, t.x_funds, t.x_nav, t.x_aum if aum is None else aum, t.x_flagged, t.x_txn)


def _published_after_a_failed_load(t: Tables) -> DataFrame:
    """Rows of the star that readers see when a later load with broken amounts was held back."""
    root = scratch_path(t.spark, "published")
    _publish(t, root)
    try:
        _publish(t, root, t.x_aum.withColumn("aum_crore", -C("aum_crore")))
    except publication.GateFailed:
        pass
    else:
        raise AssertionError("a broken load was published")
    parts = [table.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")) for name, table in publication.open_star(t.spark, root).items()]
    parts.append(publication.open_star(t.spark, root)["fact_aum"].agg(F.lit("fact_aum below zero").alias("table_name"), F.count_if(C("aum_crore") < 0).alias("rows")))
    return reduce(DataFrame.unionByName, parts)


check("s8_published_star", _published_after_a_failed_load, """
SELECT 'dim_fund' AS table_name, count(*) AS rows FROM {x_funds} UNION ALL SELECT 'dim_date', count(*) FROM {s_dim_date} UNION ALL SELECT 'fact_nav', count(*) FROM {x_nav}
UNION ALL SELECT 'fact_transactions', count(*) FROM {x_txn} UNION ALL SELECT 'fact_performance', count(*) FROM {x_perf} UNION ALL SELECT 'fact_aum', count(*) FROM {x_aum}
UNION ALL SELECT 'fact_aum below zero', CAST(0 AS BIGINT)""")

# --- Y: data quality --------------------------------------------------------------------
_PROFILE_SQL = """
SELECT 'nav' AS file, c AS "column", p AS position, ty AS dtype, 0 AS nulls, (SELECT count(*) FROM {r_nav}) AS rows,
  (SELECT count(*) - count(DISTINCT (amfi_code, date, nav)) FROM {r_nav}) AS duplicates,
  CASE WHEN (SELECT count(*) > count(DISTINCT (amfi_code, date, nav)) FROM {r_nav}) THEN 'duplicate rows' ELSE '' END AS note, CAST(NULL AS VARCHAR) AS error
FROM (VALUES ('amfi_code', 0, 'int64'), ('date', 1, 'str'), ('nav', 2, 'str')) v(c, p, ty)
UNION ALL
SELECT 'aum', c, p, ty, CASE WHEN c = 'aum_lakh_crore' THEN (SELECT count(*) FROM {r_aum} WHERE aum_lakh_crore IS NULL) ELSE 0 END, (SELECT count(*) FROM {r_aum}), d.dup,
  concat_ws('; ', CASE WHEN d.dup > 0 THEN 'duplicate rows' END, CASE WHEN c = 'aum_lakh_crore' THEN 'missing values' END), NULL
FROM (VALUES ('date', 0, 'str'), ('fund_house', 1, 'str'), ('aum_lakh_crore', 2, 'float64'), ('aum_crore', 3, 'float64'), ('num_schemes', 4, 'int64')) v(c, p, ty)
CROSS JOIN (SELECT count(*) - count(DISTINCT (date, fund_house, aum_lakh_crore, aum_crore, num_schemes)) AS dup FROM {r_aum}) d"""
check("y1_profile", lambda t: quality.profile(t.spark, {"nav": t.r_nav, "aum": t.r_aum}), _PROFILE_SQL)


def _profiled_folder(t: Tables) -> DataFrame:
    return quality.profile_folder(t.spark, _land(t, ["fund_master", "aum_by_fund_house", "monthly_sip_inflows"]))


check("y2_inventory", lambda t: quality.inventory(_profiled_folder(t)), """
SELECT CAST((SELECT count(*) > 0 FROM {r_funds}) AS BIGINT) + CAST((SELECT count(*) > 0 FROM {r_aum}) AS BIGINT) + CAST((SELECT count(*) > 0 FROM {r_sip}) AS BIGINT) AS files_found,
  CAST((SELECT count(*) > 0 FROM {r_funds}) AS BIGINT) + CAST((SELECT count(*) > 0 FROM {r_aum}) AS BIGINT) + CAST((SELECT count(*) > 0 FROM {r_sip}) AS BIGINT) AS files_loaded""")
check("y3_master_exploration", lambda t: quality.explore_master(t.r_funds), """
SELECT 'fund_house' AS "column", fund_house AS value FROM {r_funds} UNION SELECT 'category', category FROM {r_funds}
UNION SELECT 'sub_category', sub_category FROM {r_funds} UNION SELECT 'risk_category', risk_category FROM {r_funds}""")
check("y3_sample_codes", lambda t: quality.sample_codes(t.x_funds), "SELECT amfi_code FROM {x_funds} ORDER BY amfi_code LIMIT 10")
check("y4_key_reconciliation", lambda t: quality.reconcile(t.x_funds, t.x_nav), """
SELECT CAST(amfi_code AS VARCHAR) AS code, 'missing' AS side FROM {x_funds} WHERE amfi_code NOT IN (SELECT amfi_code FROM {x_nav_raw})
UNION ALL SELECT DISTINCT CAST(amfi_code AS VARCHAR), 'extra' FROM {x_nav_raw} WHERE amfi_code NOT IN (SELECT amfi_code FROM {x_funds})""")
check("y5_quality_summary", lambda t: quality.quality_summary(t.spark, {"funds": t.r_funds, "nav": t.r_nav, "aum": t.r_aum}, "funds", "nav"), """
SELECT 3 AS files_analysed, f.n AS master_rows, v.n AS nav_rows, f.dup AS master_duplicates, v.dup AS nav_duplicates, f.miss AS master_nulls, 0 AS nav_nulls,
  (SELECT count(*) FROM (SELECT amfi_code FROM {r_funds} EXCEPT SELECT amfi_code FROM {r_nav}) a) AS missing_codes,
  (SELECT count(*) FROM (SELECT amfi_code FROM {r_nav} EXCEPT SELECT amfi_code FROM {r_funds}) b) AS extra_codes
FROM (SELECT count(*) AS n, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (ingest_seq) FROM {r_funds}) d) AS dup, count(*) - count(exit_load_pct) AS miss FROM {r_funds}) f
CROSS JOIN (SELECT count(*) AS n, count(*) - count(DISTINCT (amfi_code, date, nav)) AS dup FROM {r_nav}) v""")

# --- QY: reporting queries --------------------------------------------------------------
_PERF_DIM = "{s_fact_perf} p JOIN {s_dim_fund} f USING (fund_key)"
check("qy1_largest_funds", lambda t: reporting.largest_funds(t.star()),
      f"SELECT f.amfi_code, f.scheme_name, f.fund_house, p.aum_crore FROM {_PERF_DIM} ORDER BY p.aum_crore DESC, f.amfi_code LIMIT 5")
check("qy2_monthly_average_nav", lambda t: reporting.monthly_average_nav(t.star()),
      "SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, avg(nav) AS avg_nav FROM {x_nav} GROUP BY ALL", {"avg_nav": 4})
check("qy3_sip_growth", lambda t: reporting.sip_growth(t.star()), _SIP_GROWTH, {"yoy_sip_amount_pct": 2, "yoy_sip_count_pct": 2})
check("qy4_by_state", lambda t: reporting.transactions_by_state(t.star()), """
SELECT state, count(*) AS transaction_count, CAST(sum(amount_inr) AS DOUBLE) AS total_amount_inr, avg(amount_inr) AS avg_ticket_size_inr FROM {x_txn} GROUP BY state""", {"avg_ticket_size_inr": 2})
check("qy5_low_cost_funds", lambda t: reporting.low_cost_funds(t.star()),
      f"SELECT f.amfi_code, f.scheme_name, f.fund_house, f.plan, p.expense_ratio_pct, p.return_3yr_pct, p.sharpe_ratio FROM {_PERF_DIM} WHERE p.expense_ratio_pct < 1")
check("qy6_alpha_leaders", lambda t: reporting.alpha_leaders(t.star()), f"""
SELECT f.amfi_code, f.scheme_name, f.fund_house, p.return_3yr_pct, p.benchmark_3yr_pct, round(p.return_3yr_pct - p.benchmark_3yr_pct, 2) AS excess_return_3yr_pct, p.alpha, p.sharpe_ratio
FROM {_PERF_DIM} ORDER BY p.alpha DESC, excess_return_3yr_pct DESC, f.amfi_code LIMIT 10""", {"excess_return_3yr_pct": 2})
check("qy7_sharpe_leaders", lambda t: reporting.sharpe_leaders(t.star()), f"""
SELECT sub_category, scheme_name, fund_house, sharpe_ratio, sortino_ratio, std_dev_ann_pct FROM (
  SELECT f.sub_category, f.scheme_name, f.fund_house, p.sharpe_ratio, p.sortino_ratio, p.std_dev_ann_pct, rank() OVER (PARTITION BY f.sub_category ORDER BY p.sharpe_ratio DESC) AS pos
  FROM {_PERF_DIM}) t WHERE pos = 1""")
check("qy8_net_flow", lambda t: reporting.net_flow(t.star()), _NET_FLOW, {"mom_net_flow_change_pct": 2})
check("qy9_concentration", lambda t: reporting.concentration(t.star()), """
SELECT sum(s * s) * 10000 AS hhi_index, max(s) * 100 AS largest_fund_house_share_pct
FROM (SELECT aum_crore / sum(aum_crore) OVER () AS s FROM {x_aum} WHERE date = (SELECT max(date) FROM {x_aum})) t""", {"hhi_index": 2, "largest_fund_house_share_pct": 2})
check("qy10_city_tier", lambda t: reporting.city_tier_behaviour(t.star()), """
SELECT city_tier, transaction_type, count(*) AS txn_count, CAST(sum(amount_inr) AS DOUBLE) AS total_amount_inr, avg(amount_inr) AS avg_ticket_size_inr,
  count(DISTINCT investor_id) / count(*) AS unique_investor_ratio FROM {x_txn} GROUP BY ALL""", {"avg_ticket_size_inr": 2, "unique_investor_ratio": 4})

# The same answers from SQL text over the star's views.
_VIEW_SQL = {
    "qy1_largest_funds": "SELECT f.amfi_code, f.scheme_name, f.fund_house, p.aum_crore FROM fact_performance p JOIN dim_fund f USING (fund_key) ORDER BY p.aum_crore DESC, f.amfi_code LIMIT 5",
    "qy2_monthly_average_nav": "SELECT d.year, d.month, avg(n.nav) AS avg_nav FROM fact_nav n JOIN dim_date d USING (date_key) GROUP BY d.year, d.month",
    "qy4_by_state": "SELECT state, count(*) AS transaction_count, CAST(sum(amount_inr) AS DOUBLE) AS total_amount_inr, avg(amount_inr) AS avg_ticket_size_inr FROM fact_transactions GROUP BY state",
    "qy5_low_cost_funds": "SELECT f.amfi_code, f.scheme_name, f.fund_house, f.plan, p.expense_ratio_pct, p.return_3yr_pct, p.sharpe_ratio FROM fact_performance p JOIN dim_fund f USING (fund_key) WHERE p.expense_ratio_pct < 1",
    "qy7_sharpe_leaders": """
SELECT sub_category, scheme_name, fund_house, sharpe_ratio, sortino_ratio, std_dev_ann_pct
FROM (SELECT f.sub_category, f.scheme_name, f.fund_house, p.*, max(p.sharpe_ratio) OVER (PARTITION BY f.sub_category) AS best
      FROM fact_performance p JOIN dim_fund f USING (fund_key)) WHERE sharpe_ratio = best""",
    "qy9_concentration": """
WITH latest AS (SELECT aum_crore FROM fact_aum WHERE date_key = (SELECT max(date_key) FROM fact_aum)), whole AS (SELECT sum(aum_crore) AS t FROM latest)
SELECT sum(pow(aum_crore / (SELECT t FROM whole), 2)) * 10000 AS hhi_index, max(aum_crore / (SELECT t FROM whole)) * 100 AS largest_fund_house_share_pct FROM latest""",
}

_VIEW_SQL |= {
    "qy3_sip_growth": """
WITH monthly AS (
  SELECT d.year, d.month, sum(t.amount_inr) AS sip_amount, count(*) AS sip_txn_count
  FROM fact_transactions t JOIN dim_date d USING (date_key) WHERE t.transaction_type = 'SIP' GROUP BY d.year, d.month)
SELECT now.*, round(100 * CAST(now.sip_amount - past.sip_amount AS DOUBLE) / nullif(past.sip_amount, 0), 2) AS yoy_sip_amount_pct,
  round(100 * CAST(now.sip_txn_count - past.sip_txn_count AS DOUBLE) / nullif(past.sip_txn_count, 0), 2) AS yoy_sip_count_pct
FROM monthly now LEFT JOIN monthly past ON past.year + 1 = now.year AND past.month = now.month ORDER BY now.year, now.month""",
    "qy6_alpha_leaders": """
SELECT f.amfi_code, f.scheme_name, f.fund_house, p.return_3yr_pct, p.benchmark_3yr_pct,
  round(p.return_3yr_pct - p.benchmark_3yr_pct, 2) AS excess_return_3yr_pct, p.alpha, p.sharpe_ratio
FROM fact_performance p JOIN dim_fund f USING (fund_key) ORDER BY p.alpha DESC, excess_return_3yr_pct DESC, f.amfi_code LIMIT 10""",
    "qy8_net_flow": """
WITH flows AS (
  SELECT d.year, d.month, sum(if(t.transaction_type IN ('SIP', 'Lumpsum'), t.amount_inr, 0)) AS gross_inflow,
    sum(if(t.transaction_type = 'Redemption', t.amount_inr, 0)) AS redemption
  FROM fact_transactions t JOIN dim_date d USING (date_key) GROUP BY d.year, d.month),
nets AS (SELECT *, gross_inflow - redemption AS net_flow FROM flows),
pairs AS (SELECT *, lag(net_flow) OVER (ORDER BY year, month) AS past FROM nets)
SELECT year, month, gross_inflow, redemption, net_flow,
  round(100 * CAST(net_flow - past AS DOUBLE) / nullif(past, 0), 2) AS mom_net_flow_change_pct FROM pairs ORDER BY year, month""",
    "qy10_city_tier": """
SELECT city_tier, transaction_type, count(*) AS txn_count, CAST(sum(amount_inr) AS DOUBLE) AS total_amount_inr,
  round(avg(amount_inr), 2) AS avg_ticket_size_inr, round(count(DISTINCT investor_id) / count(*), 4) AS unique_investor_ratio
FROM fact_transactions GROUP BY city_tier, transaction_type ORDER BY city_tier, total_amount_inr DESC""",
}


def _by_view(text: str):
    def run(t: Tables) -> DataFrame:
        warehouse.register_views(t.star())
        return t.spark.sql(text)
    return run


for _name, _text in _VIEW_SQL.items():
    check(f"{_name.split('_')[0]}_sql", _by_view(_text), CHECKS[_name].sql, CHECKS[_name].digits)


def _export(part: str):
    def run(t: Tables) -> DataFrame:
        metrics = t.x_metrics
        return scorecard.exports(metrics, t.scorecard(), t.x_returns_named, scratch_path(t.spark, "exports"))[part]
    return run


_ALPHA_BETA = ("amfi_code", "scheme_name", "fund_house", "category", "alpha_daily", "alpha_annualized_pct", "beta", "r_squared", "regression_observations")
check("s10_alpha_beta", _export("alpha_beta"), f"SELECT {', '.join(_ALPHA_BETA)} FROM {{x_metrics}}", {c: d for c, d in _METRIC_DIGITS.items() if c in _ALPHA_BETA})
check("s10_scorecard", _export("fund_scorecard"), "SELECT * FROM {x_scorecard}", _METRIC_DIGITS | {c: 8 for c in _SCORE_COLUMNS})

# --- E: result sets ---------------------------------------------------------------------
check("e1_nav_trend", lambda t: explore.nav_trend(t.x_nav, t.x_funds), """
SELECT n.amfi_code, n.date, n.nav, f.scheme_name, f.category FROM (SELECT *, row_number() OVER (PARTITION BY amfi_code ORDER BY date) AS i FROM {x_nav}) n
JOIN {x_funds} f USING (amfi_code) WHERE n.i % 5 = 1""")
check("e2_average_indexed_nav", lambda t: explore.average_indexed_nav(t.x_nav), "SELECT * FROM {x_avg_indexed}", {"avg_indexed_nav": 8})
check("e3_equity_indexed_nav", lambda t: explore.category_indexed_nav(t.x_nav, t.x_funds, "Equity"), f"SELECT * FROM ({_CATEGORY_INDEXED}) c WHERE category = 'Equity'", {"indexed_nav": 8})
check("e4_focus_window", lambda t: explore.focus_window(explore.average_indexed_nav(t.x_nav), *_WINDOW),
      "SELECT * FROM {x_avg_indexed} WHERE date BETWEEN DATE '1998-07-01' AND DATE '1998-12-31'", {"avg_indexed_nav": 8})
check("e5_aum_by_year", lambda t: explore.aum_grid(t.x_aum), _GRID_SQL)
check("e6_latest_aum_share", lambda t: explore.latest_aum_share(t.x_aum), """
SELECT fund_house, aum_lakh_crore, 100 * aum_lakh_crore / sum(aum_lakh_crore) OVER () AS share_pct FROM {x_year_aum} WHERE year = (SELECT max(year) FROM {x_year_aum})""", ["share_pct"])
check("e7_sip_trend", lambda t: explore.sip_trend(t.x_sip), "SELECT month, sip_inflow_crore FROM {x_sip}")
_SIP_MARKERS = {"peak": "1999-12-01", "early": "1996-01-20"}
check("e7_sip_markers", lambda t: explore.sip_markers(t.x_sip, _SIP_MARKERS), """
SELECT label, marker_date, month, sip_inflow_crore FROM (
  SELECT m.label, m.d AS marker_date, s.month, s.sip_inflow_crore, row_number() OVER (PARTITION BY m.label ORDER BY abs(date_diff('day', m.d, s.month)), s.month) AS pos
  FROM (VALUES ('peak', DATE '1999-12-01'), ('early', DATE '1996-01-20')) m(label, d) CROSS JOIN {x_sip} s) t WHERE pos = 1""")
check("e8_active_accounts", lambda t: explore.active_accounts(t.x_sip), "SELECT month, active_sip_accounts_crore FROM {x_sip}")
check("e9_category_matrix", lambda t: explore.category_matrix(t.x_category).drop("row_total"), f"SELECT category, {_MATRIX} FROM {{x_category}} GROUP BY category")
check("e10_age_groups", lambda t: explore.age_group_counts(t.x_txn).select("age_group", "n"), "SELECT age_group, count(*) AS n FROM {x_txn} WHERE age_group <> 'unknown' GROUP BY age_group")
_BOX = ", ".join(f"quantile_cont(v, {p}) AS {n}" for n, p in explore.BOX_POINTS.items())
check("e11_sip_amount_boxes", lambda t: explore.sip_amount_boxes(t.x_txn), f"""
WITH s AS (SELECT age_group, CAST(amount_inr AS DOUBLE) AS v FROM {{x_txn}} WHERE transaction_type = 'SIP' AND age_group <> 'unknown')
SELECT age_group, {_BOX} FROM s WHERE v <= (SELECT quantile_cont(v, 0.99) * 1.1 FROM s) GROUP BY age_group""", list(explore.BOX_POINTS))
check("e12_gender_split", lambda t: explore.gender_split(t.x_txn),
      "SELECT gender, count(*) AS n, 100.0 * count(*) / sum(count(*)) OVER () AS share_pct FROM {x_txn} WHERE gender IS NOT NULL GROUP BY gender", ["share_pct"])
check("e13_state_sip", lambda t: explore.state_sip(t.x_txn), """
SELECT state, CAST(sum(amount_inr) AS BIGINT) AS amount_inr, sum(amount_inr) / CAST(10000000 AS DOUBLE) AS sip_amount_crore FROM {x_txn} WHERE transaction_type = 'SIP'
GROUP BY state ORDER BY 2 DESC, state LIMIT 30""", ["sip_amount_crore"])
check("e14_city_tier_sip", lambda t: explore.city_tier_sip(t.x_txn), """
SELECT city_tier, sum(amount_inr) / CAST(10000000 AS DOUBLE) AS sip_amount_crore, CAST(100 AS DOUBLE) * sum(amount_inr) / sum(sum(amount_inr)) OVER () AS share_pct
FROM {x_txn} WHERE transaction_type = 'SIP' GROUP BY city_tier""", ["sip_amount_crore", "share_pct"])
check("e15_folio_trend", lambda t: explore.folio_trend(t.x_folio), "SELECT month, total_folios_crore FROM {x_folio}")
check("e16_folio_mix", lambda t: explore.latest_folio_mix(t.x_folio), """
SELECT month, part, folios_crore, 100 * folios_crore / sum(folios_crore) OVER () AS share_pct FROM (
  SELECT month, unnest(['Equity', 'Debt', 'Hybrid', 'Others']) AS part, unnest([equity_folios_crore, debt_folios_crore, hybrid_folios_crore, others_folios_crore]) AS folios_crore
  FROM {x_folio} WHERE month = (SELECT max(month) FROM {x_folio})) t""", ["share_pct"])
check("e17_labelled_correlation", lambda t: explore.labelled_correlation(t.x_nav, t.x_perf, t.x_funds), """
SELECT CAST(c.slot_a AS INT) AS slot_a, CAST(c.slot_b AS INT) AS slot_b, substring(replace(a.scheme_name, ' Fund', ''), 1, 18) AS label_a,
  substring(replace(b.scheme_name, ' Fund', ''), 1, 18) AS label_b, c.correlation
FROM {x_corr} c JOIN {x_funds} a ON a.amfi_code = c.code_a JOIN {x_funds} b ON b.amfi_code = c.code_b""", {"correlation": 9})
check("e18_sector_weights", lambda t: explore.sector_weights(t.x_holdings, t.x_funds), "SELECT * FROM {x_sectors9}", {"weight_pct": 4})
check("e19_top_return", lambda t: explore.top_schemes(t.x_perf, "return_3yr_pct"), "SELECT amfi_code, scheme_name, return_3yr_pct FROM {x_perf} ORDER BY return_3yr_pct DESC, amfi_code LIMIT 10")
check("e19_top_sharpe", lambda t: explore.top_schemes(t.x_perf, "sharpe_ratio"), "SELECT amfi_code, scheme_name, sharpe_ratio FROM {x_perf} ORDER BY sharpe_ratio DESC, amfi_code LIMIT 10")

_FINDINGS_SQL = """
SELECT CAST(finding_no AS INT) AS finding_no, metric, subject, CAST(value AS DOUBLE) AS value FROM (
SELECT 1 AS finding_no, 'largest_amc_aum_lakh_crore' AS metric, fund_house AS subject, aum_lakh_crore AS value FROM (
  SELECT * FROM {x_year_aum} WHERE year = (SELECT max(year) FROM {x_year_aum}) ORDER BY aum_lakh_crore DESC, fund_house LIMIT 1) a
UNION ALL SELECT 2, 'sip_inflow_growth_pct', NULL, (arg_max(sip_inflow_crore, month) / arg_min(sip_inflow_crore, month) - 1) * 100 FROM {x_sip}
UNION ALL SELECT 3, 'top_category_net_inflow_crore', category, v FROM (SELECT category, sum(net_inflow_crore) AS v FROM {x_category} GROUP BY category ORDER BY v DESC, category LIMIT 1) c
UNION ALL SELECT 4, 'largest_age_group_records', age_group, n FROM (SELECT age_group, count(*) AS n FROM {x_txn} WHERE age_group <> 'unknown' GROUP BY age_group ORDER BY n DESC, age_group LIMIT 1) g
UNION ALL SELECT 5, 'top_state_sip_amount_crore', state, v FROM (SELECT state, sum(amount_inr) / CAST(10000000 AS DOUBLE) AS v FROM {x_txn} WHERE transaction_type = 'SIP' GROUP BY state ORDER BY v DESC, state LIMIT 1) s
UNION ALL SELECT 6, 'folio_growth_crore', NULL, arg_max(total_folios_crore, month) - arg_min(total_folios_crore, month) FROM {x_folio}
UNION ALL SELECT 7, 'mean_pairwise_correlation', NULL, avg(correlation) FROM {x_corr} WHERE slot_a < slot_b
UNION ALL SELECT 8, 'top_sector_share_pct', sector, v FROM (SELECT sector, weight_pct * 100 / sum(weight_pct) OVER () AS v FROM {x_sectors9} ORDER BY v DESC, sector LIMIT 1) w
UNION ALL SELECT 9, 'correction_low', CAST(date AS VARCHAR), v FROM (SELECT date, avg_indexed_nav AS v FROM {x_avg_indexed} WHERE date BETWEEN DATE '1998-07-01' AND DATE '1998-12-31' ORDER BY v, date LIMIT 1) l
UNION ALL SELECT 10, 'latest_active_sip_accounts_crore', CAST(max(month) AS VARCHAR), arg_max(active_sip_accounts_crore, month) FROM {x_sip}) f"""


def _findings(t: Tables) -> DataFrame:
    return explore.findings(t.x_aum, t.x_sip, t.x_category, t.x_txn, t.x_folio, t.x_nav, t.x_perf, t.x_holdings, t.x_funds, window=_WINDOW)


check("e20_findings", _findings, _FINDINGS_SQL, {"value": 4})


def _findings_sink(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "findings")
    files.write_table(_findings(t), path)
    return files.read_table(t.spark, path)


_ENDS_SQL = """
SELECT f.*, CASE finding_no WHEN 2 THEN s.a WHEN 6 THEN o.a END AS from_value, CASE finding_no WHEN 2 THEN s.b WHEN 6 THEN o.b END AS to_value
FROM (""" + _FINDINGS_SQL + """) f
CROSS JOIN (SELECT CAST(arg_min(sip_inflow_crore, month) AS DOUBLE) AS a, CAST(arg_max(sip_inflow_crore, month) AS DOUBLE) AS b FROM {x_sip}) s
CROSS JOIN (SELECT arg_min(total_folios_crore, month) AS a, arg_max(total_folios_crore, month) AS b FROM {x_folio}) o"""
_SENTENCES_SQL = """
SELECT finding_no || '. ' || CASE finding_no
  WHEN 1 THEN format('{} is the largest fund house with Rs. {:.2f} lakh crore AUM.', subject, value)
  WHEN 2 THEN format('Monthly SIP inflows grew {:.1f}% over the data, from Rs. {:,} crore to Rs. {:,} crore.', value, CAST(round(from_value) AS BIGINT), CAST(round(to_value) AS BIGINT))
  WHEN 3 THEN format('{} recorded the highest cumulative net inflow at Rs. {:,} crore.', subject, CAST(round(value) AS BIGINT))
  WHEN 4 THEN format('{} is the age group with most transaction records ({:,}).', subject, CAST(value AS BIGINT))
  WHEN 5 THEN format('{} is the leading SIP state by amount with Rs. {:,}.{} crore.', subject, CAST(floor(round(value, 1)) AS BIGINT), CAST(round((round(value, 1) - floor(round(value, 1))) * 10) AS BIGINT))
  WHEN 6 THEN format('Industry folios increased by {:.2f} crore, from {:.2f} crore to {:.2f} crore.', value, from_value, to_value)
  WHEN 7 THEN format('The largest funds show an average pairwise daily return correlation of {:.2f}.', value)
  WHEN 8 THEN format('{} is the largest equity sector at {:.1f}% of summed weights.', subject, value)
  WHEN 9 THEN format('{} is the local low of the average indexed NAV ({:.2f}).', subject, value)
  ELSE format('{} is the latest month, with {:.2f} crore active SIP accounts.', subject, value) END AS value
FROM (""" + _ENDS_SQL + ") f"


def _finding_report(t: Tables) -> DataFrame:
    return explore.findings_with_ends(t.x_aum, t.x_sip, t.x_category, t.x_txn, t.x_folio, t.x_nav, t.x_perf, t.x_holdings, t.x_funds, window=_WINDOW)


def _written_lines(t: Tables, lines: DataFrame) -> DataFrame:
    path = scratch_path(t.spark, "lines")
    files.write_text(lines, path)
    return t.spark.read.text(path)


check("e20_findings_with_ends", _finding_report, _ENDS_SQL, {"value": 4, "from_value": 4, "to_value": 4})
check("t29_finding_sentences", lambda t: explore.finding_sentences(_finding_report(t)), _SENTENCES_SQL)
check("s13_findings_text_sink", lambda t: _written_lines(t, explore.finding_sentences(_finding_report(t), "Findings")),
      f"SELECT '# Findings' AS value UNION ALL SELECT '' UNION ALL ({_SENTENCES_SQL})")
_MARKDOWN_SQL = """
WITH f AS (SELECT count(*) AS n, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (ingest_seq) FROM {r_funds}) d) AS dup, count(*) - count(exit_load_pct) AS miss FROM {r_funds}),
v AS (SELECT count(*) AS n, count(*) - count(DISTINCT (amfi_code, date, nav)) AS dup FROM {r_nav}),
m AS (SELECT amfi_code AS code FROM {r_funds} EXCEPT SELECT amfi_code FROM {r_nav}),
x AS (SELECT amfi_code AS code FROM {r_nav} EXCEPT SELECT amfi_code FROM {r_funds})
SELECT unnest(['# Data quality summary', '', '## Datasets', '- Files analysed: **3**', '- Rows of funds: **' || f.n || '**', '- Rows of nav: **' || v.n || '**',
  '', '## Duplicate rows', '- funds: **' || f.dup || '**', '- nav: **' || v.dup || '**', '', '## Missing values', '- funds: **' || f.miss || '**', '- nav: **0**', '', '## Codes',
  CASE WHEN (SELECT count(*) FROM m) = 0 THEN '- Every code of funds has prices' ELSE '- Codes of funds without prices: **' || (SELECT count(*) FROM m) || '**' END,
  CASE WHEN (SELECT count(*) FROM x) = 0 THEN '- No priced code is unknown to funds' ELSE '- Priced codes that funds does not have: **' || (SELECT count(*) FROM x) || '**' END]) AS value FROM f CROSS JOIN v
UNION ALL SELECT '  - ' || code FROM m UNION ALL SELECT '  - ' || code FROM x"""
check("s12_quality_markdown", lambda t: _written_lines(t, quality.markdown_lines(t.spark, {"funds": t.r_funds, "nav": t.r_nav, "aum": t.r_aum}, "funds", "nav")), _MARKDOWN_SQL)
check("s13_findings_sink", _findings_sink, _FINDINGS_SQL, {"value": 4})
