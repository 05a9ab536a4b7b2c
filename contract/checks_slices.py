"""Checks of the forms for long series, many funds and whole tables: the same figures by another plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.registry import check
from fundlake.operators import correlation, scan
from fundlake.operators.scan import Running
from fundlake.plans import explore, returns

C = F.col
_TICKS = "OVER (PARTITION BY series ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"


def _running(out: str, how: Running):
    return lambda t: scan.running(t.x_ticks, ["series"], ["ts", "event_id"], {out: how}).select("event_id", "series", out)


check("w3_running_max_by_slices", _running("peak", Running("max", "value")), f"SELECT event_id, series, max(value) {_TICKS} AS peak FROM {{x_ticks}}")
check("w3_running_sum_by_slices", _running("total", Running("sum", "cents")), f"SELECT event_id, series, CAST(sum(cents) {_TICKS} AS BIGINT) AS total FROM {{x_ticks}}")
check("w4_forward_fill_by_slices", _running("last_value", Running("known", "value")),
      f"SELECT event_id, series, last_value(value IGNORE NULLS) {_TICKS} AS last_value FROM {{x_ticks}}")
check("k1_gap_fill_by_slices", lambda t: scan.fill_calendar(t.x_tick_days, "series", "day", "value"), """
SELECT s.series, CAST(s.d AS DATE) AS day, r.value
FROM (SELECT series, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS d FROM {x_tick_days} GROUP BY series) s
ASOF JOIN {x_tick_days} r ON s.series = r.series AND CAST(s.d AS DATE) >= r.day""")
check("m8_max_drawdown_by_slices", lambda t: returns.max_drawdown_by_slices(t.x_nav), "SELECT * FROM {x_drawdown}", {"max_drawdown_pct": 9})
check("j10_as_of_many",
      lambda t: scan.as_of_join(t.x_ticks.where("event_type <> 'view'").select("event_id", "series", "ts"), t.x_ticks.where("event_type = 'view'").select("series", "ts", "cents"), ["series"], "ts", ["cents"]).select("event_id", "series", "cents"), """
SELECT p.event_id, p.series, v.cents FROM (SELECT * FROM {x_ticks} WHERE event_type <> 'view') p
ASOF LEFT JOIN (SELECT series, ts, cents FROM {x_ticks} WHERE event_type = 'view') v ON v.series = p.series AND p.ts >= v.ts""")
check("j10_transactions_as_of_price",
      lambda t: scan.as_of_join(t.x_txn.select("investor_id", "amfi_code", "transaction_date", "amount_inr"), t.x_nav_raw.where("amfi_code % 5 <> 0"), ["amfi_code"], "transaction_date", ["nav"], "date",
                                tolerance=F.date_sub("transaction_date", 2)), """
SELECT t.investor_id, t.amfi_code, t.transaction_date, t.amount_inr, CASE WHEN n.date >= t.transaction_date - 2 THEN n.date END AS date_as_of,
  CASE WHEN n.date >= t.transaction_date - 2 THEN n.nav END AS nav
FROM {x_txn} t ASOF LEFT JOIN (SELECT * FROM {x_nav_raw} WHERE amfi_code % 5 <> 0) n ON n.amfi_code = t.amfi_code AND t.transaction_date >= n.date""")

_ALL_PAIRS = """
WITH full_days AS (SELECT date FROM {x_returns} WHERE daily_return IS NOT NULL GROUP BY date HAVING count(*) = (SELECT count(DISTINCT amfi_code) FROM {x_returns})),
r AS (SELECT amfi_code, date, daily_return AS v FROM {x_returns} JOIN full_days USING (date))
SELECT a.amfi_code AS code_a, b.amfi_code AS code_b, count(*) AS days, corr(a.v, b.v) AS correlation FROM r a JOIN r b ON a.date = b.date AND a.amfi_code <= b.amfi_code GROUP BY ALL"""
check("a16_correlation_all_series", lambda t: correlation.correlations(t.x_returns, "amfi_code", "daily_return", block=8), _ALL_PAIRS, {"correlation": 9})
check("m14_return_correlation_chosen",
      lambda t: correlation.correlations(t.x_returns, "amfi_code", "daily_return", keys=explore.largest_by_aum(t.x_perf)).select("code_a", "code_b", "correlation"),
      "SELECT code_a, code_b, correlation FROM {x_corr} WHERE code_a <= code_b", {"correlation": 9})
