"""Checks for joins, aggregates, windows, sorting, set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contract.registry import check
from contract.tables import Tables
from fundlake import schemas as S
from fundlake.functions import rules
from fundlake.operators import aggregates, ranking, reshape, series, sets
from fundlake.plans import explore, returns, warehouse

C = F.col
_CODES = list(range(25))


def _fund_map(t: Tables) -> DataFrame:
    return t.star()["dim_fund"].select("fund_key", "amfi_code")


# --- J: joins -------------------------------------------------------------------------
check("j1_nav_fund_map", lambda t: warehouse.fact_nav(t.x_nav, _fund_map(t)), "SELECT * FROM {s_fact_nav}")
check("j2_transaction_fund_map", lambda t: warehouse.fact_transactions(t.x_txn, _fund_map(t)).drop("transaction_key"), "SELECT * FROM {s_fact_txn}")
check("j3_performance_fund_map", lambda t: warehouse.fact_performance(t.x_flagged, _fund_map(t)), "SELECT * FROM {s_fact_perf}")
check("j4_nav_metadata", lambda t: t.x_nav_raw.join(t.x_funds.where(C("category") != "Hybrid").select("amfi_code", "scheme_name"), "amfi_code", "left"),
      "SELECT n.amfi_code, n.date, n.nav, f.scheme_name FROM {x_nav_raw} n LEFT JOIN (SELECT * FROM {x_funds} WHERE category <> 'Hybrid') f USING (amfi_code)")


def _matched(t: Tables) -> DataFrame:
    market = t.x_index_returns.where(C("index_name") == S.MARKET_INDEX).select("date", "benchmark_return")
    both = t.x_returns.join(F.broadcast(market), "date")
    return both.dropna(subset=["daily_return", "benchmark_return"]).select("amfi_code", "date", "daily_return", "benchmark_return")


check("j5_returns_with_market", _matched, """
SELECT r.amfi_code, r.date, r.daily_return, m.benchmark_return FROM {x_returns} r JOIN {x_index_returns} m ON r.date = m.date
WHERE m.index_name = 'NIFTY100' AND r.daily_return IS NOT NULL AND m.benchmark_return IS NOT NULL""", {"daily_return": 9, "benchmark_return": 9})


def _mapped(t: Tables) -> DataFrame:
    keyed = t.x_returns.join(t.x_funds.select("amfi_code", rules.benchmark_key(C("benchmark")).alias("index_name")), "amfi_code")
    both = keyed.join(t.x_index_returns.select("date", "index_name", "benchmark_return"), ["date", "index_name"])
    return both.dropna(subset=["daily_return", "benchmark_return"]).select("amfi_code", "date", "index_name", "benchmark_return")


check("j6_returns_with_own_index", _mapped, """
SELECT r.amfi_code, r.date, m.index_name, m.benchmark_return FROM {x_returns} r JOIN {x_fund_index} k USING (amfi_code)
JOIN {x_index_returns} m ON m.date = r.date AND m.index_name = k.tracking_benchmark
WHERE r.daily_return IS NOT NULL AND m.benchmark_return IS NOT NULL""", {"benchmark_return": 9})
check("j7_star_join_fund",
      lambda t: t.star()["fact_transactions"].join(t.star()["dim_fund"].select("fund_key", "fund_house", "plan"), "fund_key").groupBy("fund_house", "plan").agg(F.sum("amount_inr").alias("amount_inr")),
      "SELECT f.fund_house, f.plan, CAST(sum(t.amount_inr) AS BIGINT) AS amount_inr FROM {x_txn} t JOIN {x_funds} f USING (amfi_code) GROUP BY ALL")
check("j8_star_join_date",
      lambda t: t.star()["fact_nav"].join(F.broadcast(t.star()["dim_date"].select("date_key", "year", "is_weekend")), "date_key").groupBy("year", "is_weekend").agg(F.count("*").alias("n"), F.max("nav").alias("max_nav")),
      "SELECT CAST(year(date) AS INT) AS year, CASE WHEN isodow(date) > 5 THEN 1 ELSE 0 END AS is_weekend, count(*) AS n, max(nav) AS max_nav FROM {x_nav} GROUP BY ALL")


def _year_before(t: Tables) -> DataFrame:
    m = t.x_sip.select(F.year("month").alias("year"), F.month("month").alias("month"), C("sip_inflow_crore").alias("amount"))
    p = m.select((C("year") + 1).alias("year"), "month", C("amount").alias("amount_before"))
    return m.join(p, ["year", "month"], "left")


check("j9_previous_year_self_join", _year_before, """
SELECT CAST(year(a.month) AS INT) AS year, CAST(month(a.month) AS INT) AS month, a.sip_inflow_crore AS amount, b.sip_inflow_crore AS amount_before
FROM {x_sip} a LEFT JOIN {x_sip} b ON b.month = CAST(a.month - INTERVAL 1 YEAR AS DATE)""")
check("j10_as_of", lambda t: series.as_of(t.x_nav_raw, F.lit("1998-06-15").cast("date"), "amfi_code", "nav"), """
SELECT amfi_code, max(date) AS date, max_by(nav, date) AS nav FROM {x_nav_raw} WHERE date <= DATE '1998-06-15' GROUP BY amfi_code""")
_MARKERS = {"start": "1990-01-01", "middle": "1998-03-17", "late": "2000-01-01"}
check("j11_nearest_marker", lambda t: series.nearest_to_markers(t.x_sip, _MARKERS, "sip_inflow_crore", "month"), """
SELECT label, marker_date, month, sip_inflow_crore FROM (
  SELECT m.label, m.d AS marker_date, s.month, s.sip_inflow_crore, row_number() OVER (PARTITION BY m.label ORDER BY abs(date_diff('day', m.d, s.month)), s.month) AS pos
  FROM (VALUES ('start', DATE '1990-01-01'), ('middle', DATE '1998-03-17'), ('late', DATE '2000-01-01')) m(label, d) CROSS JOIN {x_sip} s) t WHERE pos = 1""")
check("j12_first_after_threshold", lambda t: returns.max_drawdown(t.x_nav).select("amfi_code", "drawdown_recovery_date"),
      "SELECT amfi_code, drawdown_recovery_date FROM {x_drawdown}")
check("j13_semi_join", lambda t: t.x_nav_raw.join(explore.largest_by_aum(t.x_perf).select("amfi_code"), "amfi_code", "left_semi"),
      "SELECT * FROM {x_nav_raw} WHERE amfi_code IN (SELECT amfi_code FROM {x_top10})")
check("j14_calendar_left_join", lambda t: series.reindex_daily(t.x_nav_raw, "amfi_code", "date"), """
SELECT n.amfi_code, n.date, r.nav FROM {x_nav} n LEFT JOIN {x_nav_raw} r ON n.amfi_code = r.amfi_code AND n.date = r.date""")
check("j15_label_lookup",
      lambda t: explore.largest_by_aum(t.x_perf).join(t.x_funds.select("amfi_code", rules.short_label(C("scheme_name")).alias("label")), "amfi_code", "left").select("slot", "label"),
      "SELECT CAST(t.slot AS BIGINT) AS slot, substring(replace(f.scheme_name, ' Fund', ''), 1, 18) AS label FROM {x_top10} t JOIN {x_funds} f USING (amfi_code)")

# --- A: aggregates --------------------------------------------------------------------
check("a1_one_key", lambda t: t.x_txn.groupBy("state").agg(F.count("*").alias("n"), F.sum("amount_inr").alias("total"), F.avg("amount_inr").alias("mean")),
      "SELECT state, count(*) AS n, CAST(sum(amount_inr) AS BIGINT) AS total, avg(amount_inr) AS mean FROM {x_txn} GROUP BY state", ["mean"])
check("a2_two_keys", lambda t: t.x_txn.groupBy("city_tier", "transaction_type").agg(F.count("*").alias("n"), F.sum("amount_inr").alias("total")),
      "SELECT city_tier, transaction_type, count(*) AS n, CAST(sum(amount_inr) AS BIGINT) AS total FROM {x_txn} GROUP BY ALL")
check("a3_distinct_ratio", lambda t: t.x_txn.groupBy("city_tier").agg((F.countDistinct("investor_id") / F.count("*")).alias("ratio")),
      "SELECT city_tier, count(DISTINCT investor_id) / count(*) AS ratio FROM {x_txn} GROUP BY city_tier", ["ratio"])
check("a4_conditional_sum", lambda t: t.x_txn.groupBy("state").agg(aggregates.sum_if(C("transaction_type") == "Redemption", C("amount_inr")).alias("redemption")),
      "SELECT state, CAST(sum(CASE WHEN transaction_type = 'Redemption' THEN amount_inr ELSE 0 END) AS BIGINT) AS redemption FROM {x_txn} GROUP BY state")
check("a5_max_by_group", lambda t: t.x_perf.groupBy("category").agg(F.max("sharpe_ratio").alias("best")),
      "SELECT category, max(sharpe_ratio) AS best FROM {x_perf} GROUP BY category")
check("a6_global", lambda t: t.x_txn.agg(F.sum("amount_inr").alias("total"), F.max("amount_inr").alias("largest")),
      "SELECT CAST(sum(amount_inr) AS BIGINT) AS total, max(amount_inr) AS largest FROM {x_txn}")
check("a7_group_sum_sorted", lambda t: explore.category_totals(t.x_category),
      "SELECT category, sum(net_inflow_crore) AS net_inflow_crore FROM {x_category} GROUP BY category ORDER BY 2 DESC", {"net_inflow_crore": 2})
check("a8_value_counts", lambda t: aggregates.value_counts(t.x_txn, "gender"), "SELECT gender, count(*) AS n FROM {x_txn} WHERE gender IS NOT NULL GROUP BY gender")
check("a9_fixed_order_counts", lambda t: explore.age_group_counts(t.x_txn.where(C("age_group") != "36-45")), """
SELECT age_group, count(*) AS n, CAST(CASE age_group WHEN '18-25' THEN 1 WHEN '26-35' THEN 2 WHEN '46-55' THEN 4 ELSE 5 END AS BIGINT) AS position
FROM {x_txn} WHERE age_group IN ('18-25', '26-35', '46-55', '56+') GROUP BY age_group""")
# Prices cut to 1/1024 add up exactly in both engines, so these means need no rounding.
_EXACT_NAV = "floor(nav * 1024) / 1024"


def _exact_nav(t: Tables) -> DataFrame:
    return t.x_nav.withColumn("nav", F.expr(_EXACT_NAV))


check("a10_mean_group_date", lambda t: _exact_nav(t).join(t.x_funds.select("amfi_code", "category"), "amfi_code").groupBy("date", "category").agg(F.avg("nav").alias("avg_nav")),
      f"SELECT n.date, f.category, avg({_EXACT_NAV}) AS avg_nav FROM {{x_nav}} n JOIN {{x_funds}} f USING (amfi_code) GROUP BY ALL")
check("a11_cross_section_mean", lambda t: explore.average_indexed_nav(t.x_nav), "SELECT * FROM {x_avg_indexed}", {"avg_indexed_nav": 8})
check("a12_sample_deviation", lambda t: t.x_returns.groupBy("amfi_code").agg(F.stddev_samp("daily_return").alias("sd")),
      "SELECT amfi_code, stddev_samp(daily_return) AS sd FROM {x_returns} GROUP BY amfi_code", {"sd": 9})
check("a13_series_statistics", lambda t: t.x_returns.groupBy("amfi_code").agg(F.min("daily_return").alias("lo"), F.max("daily_return").alias("hi"), F.avg("daily_return").alias("mean"), F.count("daily_return").alias("n")),
      "SELECT amfi_code, min(daily_return) AS lo, max(daily_return) AS hi, avg(daily_return) AS mean, count(daily_return) AS n FROM {x_returns} GROUP BY amfi_code", {"lo": 9, "hi": 9, "mean": 9})
check("a14_downside_deviation", lambda t: t.x_returns.groupBy("amfi_code").agg(aggregates.downside_deviation(C("daily_return")).alias("sd")),
      "SELECT amfi_code, stddev_samp(CASE WHEN daily_return < 0 THEN daily_return END) AS sd FROM {x_returns} GROUP BY amfi_code", {"sd": 9})
check("a15_regression",
      lambda t: _matched(t).groupBy("amfi_code").agg(*[v.alias(k) for k, v in aggregates.regression(C("daily_return"), C("benchmark_return")).items()]),
      "SELECT amfi_code, beta, alpha_daily, r_squared, regression_observations FROM {x_alpha}", {"beta": 8, "alpha_daily": 9, "r_squared": 9})
check("a16_correlation",
      lambda t: _matched(t).groupBy("amfi_code").agg(F.corr("daily_return", "benchmark_return").alias("r")),
      "SELECT r.amfi_code, corr(r.daily_return, m.benchmark_return) AS r FROM {x_returns} r JOIN {x_index_returns} m ON r.date = m.date WHERE m.index_name = 'NIFTY100' GROUP BY r.amfi_code", {"r": 9})
_POINTS = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
check("a17_exact_quantiles", lambda t: aggregates.quantiles(t.x_txn.withColumn("amount", C("amount_inr").cast("double")), "amount", _POINTS, ["transaction_type"]),
      "SELECT transaction_type, " + ", ".join(f"quantile_cont(CAST(amount_inr AS DOUBLE), {p}) AS {n}" for n, p in _POINTS.items()) + " FROM {x_txn} GROUP BY transaction_type", {n: 6 for n in _POINTS})
check("a18_argmin_argmax", lambda t: t.x_nav.groupBy("amfi_code").agg(F.min(F.struct("nav", "date")).alias("lo"), F.max(F.struct(C("nav"), -F.unix_date("date"))).alias("hi")).select("amfi_code", C("lo.date").alias("low_date"), F.date_from_unix_date(-C("hi.col2")).alias("high_date")),
      "SELECT amfi_code, min(date) FILTER (nav = lo) AS low_date, min(date) FILTER (nav = hi) AS high_date FROM (SELECT *, min(nav) OVER (PARTITION BY amfi_code) AS lo, max(nav) OVER (PARTITION BY amfi_code) AS hi FROM {x_nav}) t GROUP BY amfi_code")
check("a19_first_last", lambda t: t.x_nav.groupBy("amfi_code").agg(F.min_by("nav", "date").alias("first_nav"), F.max_by("nav", "date").alias("last_nav")),
      "SELECT amfi_code, arg_min(nav, date) AS first_nav, arg_max(nav, date) AS last_nav FROM {x_nav} GROUP BY amfi_code")
_DIST = {"p1": 0.01, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}
check("a20_distribution", lambda t: aggregates.distribution(t.x_returns, "daily_return", _DIST),
      'SELECT count(daily_return) AS "count", avg(daily_return) AS mean, stddev_samp(daily_return) AS std, min(daily_return) AS "min", max(daily_return) AS "max", '
      + ", ".join(f"quantile_cont(daily_return, {p}) AS {n}" for n, p in _DIST.items()) + " FROM {x_returns}",
      {n: 9 for n in ("mean", "std", "min", "max", *_DIST)})
check("a21_distinct_and_null_counts", lambda t: t.x_txn.agg(F.countDistinct("investor_id").alias("investors"), F.count("gender").alias("known"), F.count_if(C("gender").isNull()).alias("unknown")),
      "SELECT count(DISTINCT investor_id) AS investors, count(gender) AS known, count(*) - count(gender) AS unknown FROM {x_txn}")
check("a22_null_counts", lambda t: aggregates.null_counts(t.r_txn.select("transaction_type", "amount_inr", "state")), """
SELECT 'transaction_type' AS "column", count(*) FILTER (transaction_type IS NULL) AS nulls FROM {r_txn}
UNION ALL SELECT 'amount_inr', count(*) FILTER (amount_inr IS NULL) FROM {r_txn} UNION ALL SELECT 'state', count(*) FILTER (state IS NULL) FROM {r_txn}""")
check("a23_duplicate_rows", lambda t: aggregates.surplus_rows(t.lineitem, ["l_orderkey", "l_linenumber"]),
      "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem}) d) AS duplicate_rows FROM {lineitem}")
check("a24_row_and_column_count", lambda t: t.x_txn.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(t.x_txn.columns))),
      "SELECT count(*) AS rows, 13 AS columns FROM {x_txn}")
check("a25_share_of_total", lambda t: aggregates.with_share(t.x_aum.groupBy("fund_house").agg(F.sum("aum_crore").alias("aum")), "aum", "share"),
      "SELECT fund_house, CAST(sum(aum_crore) AS BIGINT) AS aum, sum(aum_crore) / sum(sum(aum_crore)) OVER () AS share FROM {x_aum} GROUP BY fund_house", {"share": 9})

# --- W: windows -----------------------------------------------------------------------
_OVER = "OVER (PARTITION BY amfi_code ORDER BY date)"
check("w1_lag", lambda t: t.x_nav.select("amfi_code", "date", series.previous("nav", "amfi_code").alias("previous_nav")),
      f"SELECT amfi_code, date, lag(nav) {_OVER} AS previous_nav FROM {{x_nav}}")
check("w2_pct_change", lambda t: t.x_nav.select("amfi_code", "date", series.change("nav", "amfi_code").alias("r")),
      f"SELECT amfi_code, date, nav / lag(nav) {_OVER} - 1 AS r FROM {{x_nav}}", {"r": 9})
check("w3_running_max", lambda t: t.x_nav.select("amfi_code", "date", series.running_max("nav", "amfi_code").alias("peak")),
      f"SELECT amfi_code, date, max(nav) {_OVER} AS peak FROM {{x_nav}}")
check("w4_forward_fill", lambda t: series.reindex_daily(t.x_nav_raw, "amfi_code", "date").select("amfi_code", "date", series.forward_filled("nav", "amfi_code").alias("nav")),
      "SELECT * FROM {x_nav}")
check("w5_first_value", lambda t: t.x_nav.select("amfi_code", "date", series.first_of_series("nav", "amfi_code").alias("base")),
      f"SELECT amfi_code, date, first_value(nav) {_OVER} AS base FROM {{x_nav}}")
check("w6_lag_over_months", lambda t: t.x_sip.select("month", F.lag("sip_inflow_crore").over(Window.orderBy(F.year("month"), F.month("month"))).alias("before")),
      "SELECT month, lag(sip_inflow_crore) OVER (ORDER BY month) AS before FROM {x_sip}")
check("w7_share_over_all", lambda t: explore.latest_market_share(t.x_aum),
      "SELECT fund_house, aum_crore / sum(aum_crore) OVER () AS market_share FROM {x_aum} WHERE date = (SELECT max(date) FROM {x_aum})", {"market_share": 9})
_RANKS = {"rank_sharpe": ("sharpe_ratio", False), "rank_expense": ("expense_ratio_pct", True), "rank_aum": ("aum_known", False)}
check("w8_min_rank", lambda t: ranking.min_ranks(t.x_perf.select("amfi_code", "sharpe_ratio", "expense_ratio_pct", F.when(C("amfi_code") % 5 != 0, C("aum_crore")).alias("aum_known")), _RANKS), """
SELECT amfi_code, sharpe_ratio, expense_ratio_pct, aum_known, rank() OVER (ORDER BY sharpe_ratio DESC) AS rank_sharpe,
  rank() OVER (ORDER BY expense_ratio_pct) AS rank_expense,
  CASE WHEN aum_known IS NOT NULL THEN rank() OVER (ORDER BY aum_known DESC NULLS LAST) END AS rank_aum
FROM (SELECT *, CASE WHEN amfi_code % 5 <> 0 THEN aum_crore END AS aum_known FROM {x_perf}) p""")
check("w9_row_number", lambda t: ranking.row_numbers(t.x_perf.select("amfi_code", "sharpe_ratio", "scheme_name"), [C("sharpe_ratio").desc(), C("scheme_name").asc(), C("amfi_code").asc()], "pos"),
      "SELECT amfi_code, sharpe_ratio, scheme_name, row_number() OVER (ORDER BY sharpe_ratio DESC, scheme_name, amfi_code) AS pos FROM {x_perf}")
check("w9b_every_fifth", lambda t: series.every_kth(t.x_nav, 5, "amfi_code", "nav"),
      f"SELECT amfi_code, date, nav FROM (SELECT *, row_number() {_OVER} AS i FROM {{x_nav}}) t WHERE i % 5 = 1")

# --- L: sorting and limits -------------------------------------------------------------
check("l1_sort", lambda t: t.x_txn.select("transaction_date", "investor_id", "amfi_code").orderBy("transaction_date", "investor_id", "amfi_code"),
      "SELECT transaction_date, investor_id, amfi_code FROM {x_txn} ORDER BY ALL")
check("l2_mixed_sort", lambda t: t.x_holdings.orderBy(C("amfi_code").asc_nulls_last(), C("weight_pct").desc_nulls_last()),
      "SELECT * FROM {x_holdings} ORDER BY amfi_code, weight_pct DESC NULLS LAST")
check("l3_top_n", lambda t: explore.top_schemes(t.x_perf, "return_3yr_pct", 10),
      "SELECT amfi_code, scheme_name, return_3yr_pct FROM {x_perf} ORDER BY return_3yr_pct DESC, amfi_code LIMIT 10")
check("l4_top_n_and_others", lambda t: explore.sector_weights(t.x_holdings, t.x_funds), "SELECT * FROM {x_sectors9}", {"weight_pct": 4})
check("l5_latest_per_group", lambda t: explore.yearly_aum(t.x_aum), "SELECT * FROM {x_year_aum}")
check("l6_last_of_series", lambda t: t.x_nav_raw.groupBy("amfi_code").agg(F.max(F.struct("date", "nav")).alias("e")).select("amfi_code", "e.date", "e.nav"),
      "SELECT amfi_code, max(date) AS date, arg_max(nav, date) AS nav FROM {x_nav_raw} GROUP BY amfi_code")
_MONTHS = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13) if f"{y}-{m:02d}" <= "2001-08"]
_MATRIX = ", ".join(f"sum(CASE WHEN strftime(month, '%Y-%m') = '{m}' THEN net_inflow_crore ELSE 0 END) AS \"{m}\"" for m in _MONTHS)
check("l7_row_total_order", lambda t: explore.category_matrix(t.x_category, _MONTHS).select("category", "row_total"),
      "SELECT category, sum(net_inflow_crore) AS row_total FROM {x_category} GROUP BY category", {"row_total": 2})
check("l8_head", lambda t: t.x_funds.select("amfi_code", "scheme_name").orderBy("amfi_code").limit(10),
      "SELECT amfi_code, scheme_name FROM {x_funds} ORDER BY amfi_code LIMIT 10")

# --- U: set operations -----------------------------------------------------------------
check("u1_union_all", lambda t: t.x_nav_raw.select("date").unionByName(t.x_index.select("date")).unionByName(t.x_txn.select(C("transaction_date").alias("date"))).groupBy("date").agg(F.count("*").alias("n")),
      "SELECT date, count(*) AS n FROM (SELECT date FROM {x_nav_raw} UNION ALL SELECT date FROM {x_index} UNION ALL SELECT transaction_date FROM {x_txn}) u GROUP BY date")
check("u2_key_reconciliation", lambda t: sets.reconcile_keys(t.r_funds, t.r_nav, "amfi_code"), """
SELECT coalesce(m, o) AS code, CASE WHEN o IS NULL THEN 'missing' ELSE 'extra' END AS side
FROM (SELECT DISTINCT amfi_code AS m FROM {r_funds}) a FULL JOIN (SELECT DISTINCT amfi_code AS o FROM {r_nav}) b ON m = o WHERE m IS NULL OR o IS NULL""")
check("u3_subset_assertion", lambda t: sets.outside_allowed(t.x_txn, "transaction_type", S.TRANSACTION_TYPES[:2]),
      """SELECT 'transaction_type' AS "column", count(*) AS violations FROM {x_txn} WHERE transaction_type NOT IN ('SIP', 'Lumpsum')""")

# --- P: reshape ------------------------------------------------------------------------
check("p1_pivot_unique", lambda t: reshape.pivot_unique(t.x_nav, "date", "amfi_code", "nav", _CODES),
      "SELECT date, " + ", ".join(f'max(nav) FILTER (amfi_code = {c}) AS "{c}"' for c in _CODES) + " FROM {x_nav} GROUP BY date")
check("p2_pivot_sum_fill", lambda t: explore.category_matrix(t.x_category, _MONTHS).drop("row_total"),
      f"SELECT category, {_MATRIX} FROM {{x_category}} GROUP BY category")
check("p3_pivot_mean", lambda t: reshape.pivot_mean(_exact_nav(t).join(t.x_funds.select("amfi_code", "category"), "amfi_code"), "date", "category", "nav", ["Debt", "Equity", "Hybrid"]),
      "SELECT date, " + ", ".join(f"avg({_EXACT_NAV}) FILTER (category = '{c}') AS {c}" for c in ("Debt", "Equity", "Hybrid")) + " FROM {x_nav} JOIN {x_funds} USING (amfi_code) GROUP BY date")
_YEARS = list(range(1995, 2002))
_GRID_SQL = "SELECT fund_house, " + ", ".join(f'coalesce(max(aum_lakh_crore) FILTER (year = {y}), 0) AS "{y}"' for y in _YEARS) + " FROM {x_year_aum} GROUP BY fund_house"
check("p4_year_grid", lambda t: explore.aum_grid(t.x_aum, _YEARS), _GRID_SQL)
check("p5_wide_to_long", lambda t: reshape.unpivot(t.x_folio, ["month"], ["equity_folios_crore", "debt_folios_crore"], "part", "folios"), """
SELECT month, 'equity_folios_crore' AS part, equity_folios_crore AS folios FROM {x_folio} UNION ALL SELECT month, 'debt_folios_crore', debt_folios_crore FROM {x_folio}""")
check("p6_upper_triangle", lambda t: returns.upper_triangle(returns.return_correlation(t.x_nav, explore.largest_by_aum(t.x_perf), 10)).select("slot_a", "slot_b", "correlation"),
      "SELECT CAST(slot_a AS INT) AS slot_a, CAST(slot_b AS INT) AS slot_b, correlation FROM {x_corr} WHERE slot_a < slot_b", {"correlation": 9})
