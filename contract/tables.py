"""Adapters from the driver's tables to the fund datasets.

Each adapter is one SELECT in the dialect Spark and DuckDB share, with ``{name}``
for its inputs, so both engines start from the same rows. ``x_`` tables are typed
and clean, ``r_`` tables are raw text with dirt and duplicates. The operators under
test are never part of an adapter, except ``x_nav`` and the warehouse, which have
separate SQL in ``ORACLE_ONLY``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from fundlake.functions.rules import anomaly_flags
from fundlake.operators.series import fill_calendar
from fundlake.plans import returns, scorecard, warehouse
from fundlake.session import scratch_path, setting

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
#: Joined to facts by keys of their own and growing with them: exchanged, so that no whole table passes the driver, whatever their estimated size.
EXCHANGED = ("customer",)

_FUND_TAIL = """
  CASE WHEN k % 5 = 0 THEN 'Direct' ELSE 'Regular' END AS plan,
  CAST(DATE '1990-01-01' + CAST(k % 3000 AS INT) AS DATE) AS launch_date,
  benchmark,
  CAST(5 + k % 13 AS DOUBLE) / 10 AS expense_ratio_pct,
  CAST(k % 3 AS DOUBLE) / 2 AS exit_load_pct,
  CAST(100 * (1 + k % 5) AS BIGINT) AS min_sip_amount,
  CAST(1000 * (1 + k % 4) AS BIGINT) AS min_lumpsum_amount,
  'Manager ' || CAST(k % 6 AS STRING) AS fund_manager,
  CASE k % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Moderate' ELSE 'Low' END AS risk_category,
  'S' || CAST(k % 8 AS STRING) AS sebi_category_code
"""

ADAPTERS: dict[str, str] = {
    # --- typed tables --------------------------------------------------------
    "x_orders": """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority,
  CAST(o.o_orderdate AS DATE) AS odate, c.c_mktsegment, c.c_acctbal,
  n.n_nationkey, n.n_name, r.r_regionkey, r.r_name,
  CAST(round(o.o_totalprice * 100) AS BIGINT) AS cents
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "x_nav_raw": """
SELECT CAST(n_nationkey AS BIGINT) AS amfi_code, odate AS date,
  100 + CAST(sum(cents) AS DOUBLE) / (CAST(1000000 AS DOUBLE) * count(*)) AS nav
FROM {x_orders} GROUP BY n_nationkey, odate""",
    "x_index": """
SELECT odate AS date,
  CASE r_regionkey WHEN 0 THEN 'NIFTY50' WHEN 1 THEN 'NIFTY100' WHEN 2 THEN 'NIFTY_MIDCAP150'
    WHEN 3 THEN 'BSE_SMALLCAP' ELSE 'CRISIL_GILT' END AS index_name,
  100 + CAST(sum(cents) AS DOUBLE) / (CAST(1000000 AS DOUBLE) * count(*)) AS close_value
FROM {x_orders} GROUP BY r_regionkey, odate""",
    "x_funds": """
SELECT k AS amfi_code, fund_house, scheme_name, category, sub_category,""" + _FUND_TAIL + """
FROM (
  SELECT CAST(n.n_nationkey AS BIGINT) AS k, r.r_name AS fund_house,
    n.n_name || ' Fund - Regular - Growth' AS scheme_name,
    CASE n.n_nationkey % 3 WHEN 0 THEN 'Equity' WHEN 1 THEN 'Debt' ELSE 'Hybrid' END AS category,
    'Sub ' || CAST(n.n_nationkey % 4 AS STRING) AS sub_category,
    CASE WHEN n.n_nationkey % 7 = 0 THEN 'NIFTY 500 TRI' WHEN r.r_regionkey = 0 THEN 'NIFTY 50 TRI'
      WHEN r.r_regionkey = 1 THEN 'NIFTY 100 TRI' WHEN r.r_regionkey = 2 THEN 'NIFTY Midcap 150 TRI'
      WHEN r.r_regionkey = 3 THEN 'BSE SmallCap TRI' ELSE 'CRISIL Gilt Index' END AS benchmark
  FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT 1000 + p_partkey AS k, p_brand AS fund_house,
    p_name || ' Fund ' || CAST(p_partkey AS STRING) AS scheme_name,
    CASE p_partkey % 3 WHEN 0 THEN 'Equity' WHEN 1 THEN 'Debt' ELSE 'Hybrid' END AS category,
    p_type AS sub_category, 'NIFTY 100 TRI' AS benchmark
  FROM {part}
) f""",
    "x_perf": """
SELECT k AS amfi_code, scheme_name, fund_house, category, plan,
  CAST(k * 7 % 1301 - 300 AS DOUBLE) / 10 AS return_1yr_pct,
  CAST(k * 13 % 401 - 100 AS DOUBLE) / 10 AS return_3yr_pct,
  CAST(k * 11 % 301 - 50 AS DOUBLE) / 10 AS return_5yr_pct,
  CAST(k * 5 % 301 - 50 AS DOUBLE) / 10 AS benchmark_3yr_pct,
  CAST(k % 401 - 200 AS DOUBLE) / 100 AS alpha,
  CAST(k % 260 - 20 AS DOUBLE) / 100 AS beta,
  CASE WHEN k % 20 = 0 THEN CAST(k * 13 % 401 - 100 AS DOUBLE) / 10 ELSE CAST(size AS DOUBLE) / 10 END AS sharpe_ratio,
  CAST(k % 70 AS DOUBLE) / 10 AS sortino_ratio,
  CAST(k % 300 + 50 AS DOUBLE) / 10 AS std_dev_ann_pct,
  CAST(k % 410 - 400 AS DOUBLE) / 10 AS max_drawdown_pct,
  CAST(aum AS BIGINT) AS aum_crore,
  CAST(1 + k % 25 AS DOUBLE) / 10 AS expense_ratio_pct,
  CAST(k % 7 AS BIGINT) AS morningstar_rating,
  CASE k % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Moderate' ELSE 'Low' END AS risk_grade
FROM (
  SELECT CAST(n_nationkey AS BIGINT) AS k, n_name || ' Fund - Regular - Growth' AS scheme_name,
    'House ' || CAST(n_regionkey AS STRING) AS fund_house, 'Large Cap' AS category, 'Regular' AS plan,
    n_nationkey % 50 AS size, 100000 + n_nationkey * 37 % 101 AS aum
  FROM {nation}
  UNION ALL
  SELECT 1000 + p_partkey AS k, p_name || ' Fund ' || CAST(p_partkey AS STRING) AS scheme_name,
    p_brand AS fund_house, p_type AS category, 'Direct' AS plan, p_size AS size, round(p_retailprice) AS aum
  FROM {part}
) f""",
    "x_txn": """
SELECT CAST(o_custkey AS STRING) AS investor_id, odate AS transaction_date, CAST(n_nationkey AS BIGINT) AS amfi_code,
  CASE o_orderstatus WHEN 'F' THEN 'SIP' WHEN 'O' THEN 'Lumpsum' ELSE 'Redemption' END AS transaction_type,
  CAST(round(o_totalprice) AS BIGINT) AS amount_inr, n_name AS state,
  'City ' || CAST(o_custkey % 7 AS STRING) AS city, r_name AS city_tier,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '18-25' WHEN 'BUILDING' THEN '26-35' WHEN 'FURNITURE' THEN '36-45'
    WHEN 'HOUSEHOLD' THEN '46-55' WHEN 'MACHINERY' THEN '56+' ELSE 'unknown' END AS age_group,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_custkey % 3 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  c_acctbal AS annual_income_lakh, o_orderpriority AS payment_mode,
  CASE WHEN c_acctbal < 0 THEN 'Pending' ELSE 'Verified' END AS kyc_status
FROM {x_orders}""",
    "x_aum": """
SELECT CASE WHEN month(odate) <= 6 THEN make_date(year(odate), 6, 30) ELSE make_date(year(odate), 12, 31) END AS date,
  r_name AS fund_house, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) / 100000 AS aum_lakh_crore,
  CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS aum_crore, count(DISTINCT o_custkey) AS num_schemes
FROM {x_orders} GROUP BY 1, 2""",
    "x_sip": """
SELECT make_date(year(odate), month(odate), 1) AS month,
  CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS sip_inflow_crore,
  CAST(count(DISTINCT o_custkey) AS DOUBLE) / 100 AS active_sip_accounts_crore,
  CAST(count(*) AS DOUBLE) / 10 AS new_sip_accounts_lakh,
  CAST(sum(cents) AS DOUBLE) / 10000000 AS sip_aum_lakh_crore
FROM {x_orders} GROUP BY 1""",
    "x_category": """
SELECT make_date(year(odate), month(odate), 1) AS month, c_mktsegment AS category,
  CAST(sum(CASE WHEN o_orderstatus = 'P' THEN -cents ELSE cents END) AS DOUBLE) / 100 AS net_inflow_crore
FROM {x_orders} GROUP BY 1, 2""",
    "x_folio": """
SELECT make_date(year(odate), month(odate), 1) AS month,
  CAST(count(*) AS DOUBLE) / 100 AS total_folios_crore,
  CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS DOUBLE) / 100 AS equity_folios_crore,
  CAST(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS DOUBLE) / 100 AS debt_folios_crore,
  CAST(sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END) AS DOUBLE) / 100 AS hybrid_folios_crore,
  CAST(sum(CASE WHEN o_orderpriority > '4' THEN 1 ELSE 0 END) AS DOUBLE) / 100 AS others_folios_crore
FROM {x_orders} GROUP BY 1""",
    "x_holdings": """
SELECT l_suppkey AS amfi_code, p_type || '-' || CAST(p_size AS STRING) AS stock_symbol, p_brand AS sector,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 100 AS weight_pct,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS market_value_cr
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
    # --- raw text tables -----------------------------------------------------
    "r_funds": """
SELECT CASE WHEN p_partkey % 29 = 0 THEN 'x' ELSE ' ' || CAST(p_partkey - p_partkey % 3 AS STRING) || '.0' END AS amfi_code,
  ' ' || p_brand || ' ' AS fund_house, p_name || ' Fund ' || CAST(p_partkey AS STRING) AS scheme_name,
  CASE p_partkey % 3 WHEN 0 THEN 'Equity' ELSE ' Debt' END AS category, p_type AS sub_category,
  CASE WHEN p_partkey % 41 = 0 THEN 'Other' WHEN p_partkey % 2 = 0 THEN ' Direct ' ELSE 'Regular' END AS plan,
  CASE WHEN p_partkey % 31 = 0 THEN 'soon' ELSE CAST(CAST(DATE '2000-01-01' + CAST(p_partkey % 5000 AS INT) AS DATE) AS STRING) END AS launch_date,
  CASE p_partkey % 4 WHEN 0 THEN 'NIFTY 500 TRI' WHEN 1 THEN 'Nifty Midcap 50' WHEN 2 THEN 'BSE SmallCap TRI' ELSE 'Crisil Bond' END AS benchmark,
  CAST(CAST(p_partkey % 30 AS DOUBLE) / 10 AS STRING) AS expense_ratio_pct,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE '1.0' END AS exit_load_pct,
  CASE WHEN p_partkey % 37 = 0 THEN '0' ELSE CAST(p_size * 100 AS STRING) END AS min_sip_amount,
  '5000.7' AS min_lumpsum_amount, 'Manager ' || CAST(p_partkey % 6 AS STRING) AS fund_manager,
  'High' AS risk_category, 'S' || CAST(p_partkey % 8 AS STRING) AS sebi_category_code, p_partkey AS ingest_seq
FROM {part}""",
    "r_nav": """
SELECT CAST(n_nationkey AS STRING) AS amfi_code,
  CASE WHEN o_orderkey % 13 = 0 THEN 'bad' ELSE CAST(odate AS STRING) END AS date,
  CASE WHEN o_orderkey % 19 = 0 THEN 'abc' WHEN o_orderkey % 23 = 0 THEN '-1.5'
    ELSE CAST(100 + CAST(cents AS DOUBLE) / 1000000 AS STRING) END AS nav,
  o_orderkey AS ingest_seq
FROM {x_orders}""",
    "r_aum": """
SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'bad' WHEN month(odate) <= 6 THEN CAST(year(odate) AS STRING) || '-06-30'
    ELSE CAST(year(odate) AS STRING) || '-12-31' END AS date, ' ' || r_name AS fund_house,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_totalprice / 1000 AS STRING) END AS aum_lakh_crore,
  CASE WHEN o_orderkey % 7 = 0 THEN '-1' ELSE CAST(o_totalprice AS STRING) END AS aum_crore,
  CAST(1 + o_custkey % 40 AS STRING) AS num_schemes, o_orderkey AS ingest_seq
FROM {x_orders}""",
    "r_sip": """
SELECT CASE WHEN o_orderkey % 13 = 0 THEN '2020/01' ELSE substring(CAST(odate AS STRING), 1, 7) END AS month,
  CASE WHEN o_orderkey % 5 = 0 THEN '0' ELSE CAST(o_totalprice AS STRING) END AS sip_inflow_crore,
  CAST(CAST(o_custkey % 900 + 100 AS DOUBLE) / 100 AS STRING) AS active_sip_accounts_crore,
  CASE WHEN o_orderkey % 3 = 0 THEN 'n.a.' ELSE CAST(o_custkey % 90 + 1 AS STRING) END AS new_sip_accounts_lakh,
  CAST(o_orderkey % 70 + 1 AS STRING) AS sip_aum_lakh_crore,
  CASE WHEN year(odate) = 1995 THEN NULL ELSE CAST(CAST(o_orderkey % 400 AS DOUBLE) / 10 AS STRING) END AS yoy_growth_pct,
  o_orderkey AS ingest_seq
FROM {x_orders}""",
    "r_category": """
SELECT CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE substring(CAST(odate AS STRING), 1, 7) END AS month,
  c_mktsegment || ' ' AS category,
  CASE WHEN o_orderkey % 11 = 0 THEN 'abc' WHEN o_orderstatus = 'P' THEN '-' || CAST(o_totalprice AS STRING)
    ELSE CAST(o_totalprice AS STRING) END AS net_inflow_crore, o_orderkey AS ingest_seq
FROM {x_orders}""",
    "r_folio": """
SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'May' ELSE substring(CAST(odate AS STRING), 1, 7) END AS month,
  CAST(o_totalprice AS STRING) AS total_folios_crore,
  CASE WHEN o_orderkey % 11 = 0 THEN '0' ELSE CAST(o_custkey % 50 + 1 AS STRING) END AS equity_folios_crore,
  CAST(o_custkey % 40 + 1 AS STRING) AS debt_folios_crore, CAST(o_custkey % 30 + 1 AS STRING) AS hybrid_folios_crore,
  CASE WHEN o_orderkey % 17 = 0 THEN 'x' ELSE '1.5' END AS others_folios_crore, o_orderkey AS ingest_seq
FROM {x_orders}""",
    "r_perf": """
SELECT CASE WHEN amfi_code % 29 = 0 THEN 'n/k' ELSE CAST(amfi_code - amfi_code % 3 AS STRING) END AS amfi_code,
  scheme_name, fund_house, category, plan,
  CASE WHEN amfi_code % 17 = 0 THEN 'n.a.' ELSE CAST(return_1yr_pct AS STRING) END AS return_1yr_pct,
  CAST(return_3yr_pct AS STRING) AS return_3yr_pct, CAST(return_5yr_pct AS STRING) AS return_5yr_pct,
  CAST(benchmark_3yr_pct AS STRING) AS benchmark_3yr_pct, CAST(alpha AS STRING) AS alpha, CAST(beta AS STRING) AS beta,
  CAST(sharpe_ratio AS STRING) AS sharpe_ratio, CAST(sortino_ratio AS STRING) AS sortino_ratio,
  CAST(std_dev_ann_pct AS STRING) AS std_dev_ann_pct, CAST(max_drawdown_pct AS STRING) AS max_drawdown_pct,
  CAST(aum_crore AS STRING) || '.9' AS aum_crore, ' ' || CAST(expense_ratio_pct AS STRING) AS expense_ratio_pct,
  CAST(morningstar_rating AS STRING) AS morningstar_rating, risk_grade, amfi_code AS ingest_seq
FROM {x_perf}""",
    "r_txn": """
SELECT CAST(o_custkey AS STRING) AS investor_id,
  CASE WHEN o_orderkey % 13 = 0 THEN 'bad' ELSE CAST(odate AS STRING) END AS transaction_date,
  CAST(n_nationkey AS STRING) AS amfi_code,
  CASE o_orderkey % 7 WHEN 0 THEN 'sip' WHEN 1 THEN 'SIP' WHEN 2 THEN ' Lump Sum ' WHEN 3 THEN 'redemption'
    WHEN 4 THEN 'LUMPSUM' WHEN 5 THEN NULL ELSE 'Lumpsum' END AS transaction_type,
  CASE o_orderkey % 11 WHEN 0 THEN 'abc' WHEN 1 THEN '-5' ELSE CAST(o_totalprice AS STRING) END AS amount_inr,
  n_name AS state, 'City ' || CAST(o_custkey % 7 AS STRING) AS city, r_name AS city_tier,
  c_mktsegment AS age_group, CASE WHEN o_custkey % 3 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CAST(c_acctbal AS STRING) AS annual_income_lakh, o_orderpriority AS payment_mode,
  CASE WHEN o_orderkey % 19 = 0 THEN 'VERIFIED' WHEN c_acctbal < 0 THEN 'pending' ELSE ' Verified ' END AS kyc_status,
  o_orderkey AS ingest_seq
FROM (SELECT * FROM {x_orders} UNION ALL SELECT * FROM {x_orders}) twice""",
    "r_holdings": """
SELECT CASE WHEN l_orderkey % 29 = 0 THEN '?' ELSE CAST(l_suppkey AS STRING) END AS amfi_code,
  ' ' || p_brand AS stock_symbol, p_name AS stock_name, p_type || ' ' AS sector,
  CASE WHEN l_orderkey % 7 = 0 THEN '0' ELSE CAST(l_quantity AS STRING) END AS weight_pct,
  CAST(l_extendedprice AS STRING) AS market_value_cr,
  CASE WHEN l_orderkey % 11 = 0 THEN '-' ELSE CAST(p_retailprice AS STRING) END AS current_price_inr,
  CASE WHEN l_orderkey % 13 = 0 THEN 'bad' ELSE CAST(year(l_shipdate) AS STRING) || '-12-31' END AS portfolio_date,
  lpad(CAST(l_orderkey AS STRING), 14, '0') || lpad(CAST(l_linenumber AS STRING), 3, '0')
    || CAST(CAST(l_shipdate AS DATE) AS STRING) || lpad(CAST(l_partkey AS STRING), 12, '0')
    || lpad(CAST(CAST(l_quantity AS BIGINT) AS STRING), 6, '0')
    || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING), 16, '0') AS ingest_seq
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "r_index": """
SELECT CASE WHEN o_orderkey % 13 = 0 THEN '31-12-2000' ELSE CAST(odate AS STRING) END AS date,
  ' ' || r_name || ' ' AS index_name,
  CASE WHEN o_orderkey % 11 = 0 THEN '0' ELSE CAST(o_totalprice AS STRING) END AS close_value, o_orderkey AS ingest_seq
FROM {x_orders}""",
    # Events as long series: series 0 holds nine tenths of the rows.
    "x_ticks": """
SELECT event_id, CASE WHEN event_id % 10 < 9 THEN 0 ELSE 1 + user_id % 7 END AS series, ts, event_type,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, CAST(round(value * 100) AS BIGINT) AS cents
FROM {events}""",
    "x_tick_days": """
SELECT series, CAST(ts AS DATE) AS day, max(value) AS value FROM {x_ticks} WHERE event_id % 37 = 0 GROUP BY 1, 2""",
    "x_lines": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS shipped,
  lpad(CAST(l_partkey AS STRING), 12, '0') || lpad(CAST(l_suppkey AS STRING), 12, '0')
    || CAST(CAST(l_shipdate AS DATE) AS STRING) || lpad(CAST(CAST(l_quantity AS BIGINT) AS STRING), 6, '0')
    || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING), 16, '0') AS ingest_seq
FROM {lineitem}""",
    "r_numbers": """
SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN ' 12 ' WHEN 1 THEN '12.7' WHEN 2 THEN 'abc' WHEN 3 THEN 'NaN' WHEN 4 THEN ''
    WHEN 5 THEN '12d' WHEN 6 THEN '1e3' WHEN 7 THEN chr(9) || '-.5' || chr(10) WHEN 8 THEN NULL
    ELSE CAST(o_totalprice AS STRING) END AS txt,
  CAST(o_orderkey AS STRING) AS code
FROM {orders}""",
    "r_dates": """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'bad' WHEN 1 THEN '2000-02-30' WHEN 2 THEN '31/12/2000' WHEN 3 THEN NULL
    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS txt,
  CASE o_orderkey % 5 WHEN 0 THEN '2000-13' WHEN 1 THEN 'May 2000' ELSE substring(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) END AS mon,
  CAST(o_orderdate AS DATE) AS odate
FROM {orders}""",
    "r_words": """
SELECT p_partkey, ' ' || chr(9) || p_name || chr(10) || ' ' AS padded,
  CASE p_partkey % 8 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN 'null' WHEN 3 THEN 'None' WHEN 4 THEN 'n/a' WHEN 5 THEN 'nil' ELSE p_type END AS token,
  CASE p_partkey % 6 WHEN 0 THEN 'Sip' WHEN 1 THEN ' sip' WHEN 2 THEN 'lump-sum' WHEN 3 THEN 'LUMPSUM' WHEN 4 THEN 'Redemption ' ELSE NULL END AS kind,
  CASE p_partkey % 7 WHEN 0 THEN 'Nifty 500 TRI' WHEN 1 THEN 'NIFTY 100 TRI' WHEN 2 THEN 'Nifty Midcap 50 TRI' WHEN 3 THEN 'BSE SmallCap'
    WHEN 4 THEN 'Crisil Liquid' WHEN 5 THEN 'Corporate Bond' ELSE 'X' END AS benchmark,
  p_name || ' Opportunities Fund - Regular - Growth ' || CAST(p_partkey AS STRING) AS scheme_name
FROM {part}""",
}

# SQL twins of tables that the Spark side gets from the library itself.
ORACLE_ONLY: dict[str, str] = {
    "x_nav": """
SELECT s.amfi_code, CAST(s.day AS DATE) AS date, r.nav
FROM (SELECT amfi_code, unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS day
      FROM (SELECT amfi_code, min(date) AS first_day, max(date) AS last_day FROM {x_nav_raw} GROUP BY amfi_code) b) s
ASOF JOIN {x_nav_raw} r ON s.amfi_code = r.amfi_code AND CAST(s.day AS DATE) >= r.date""",
    "x_returns": """
SELECT amfi_code, date, nav, lag(nav) OVER (PARTITION BY amfi_code ORDER BY date) AS previous_nav,
  nav / lag(nav) OVER (PARTITION BY amfi_code ORDER BY date) - 1 AS daily_return FROM {x_nav}""",
    "x_index_returns": """
SELECT date, index_name, close_value,
  close_value / lag(close_value) OVER (PARTITION BY index_name ORDER BY date) - 1 AS benchmark_return FROM {x_index}""",
    "x_fund_index": """
SELECT amfi_code, CASE WHEN upper(benchmark) LIKE '%NIFTY 50%' THEN 'NIFTY50' WHEN upper(benchmark) LIKE '%NIFTY 100%' THEN 'NIFTY100'
  WHEN upper(benchmark) LIKE '%NIFTY 500%' THEN 'NIFTY500' WHEN upper(benchmark) LIKE '%MIDCAP%' THEN 'NIFTY_MIDCAP150'
  WHEN upper(benchmark) LIKE '%SMALL%' THEN 'BSE_SMALLCAP' WHEN upper(benchmark) LIKE '%LIQUID%' THEN 'CRISIL_LIQUID'
  WHEN upper(benchmark) LIKE '%GILT%' OR upper(benchmark) LIKE '%BOND%' OR upper(benchmark) LIKE '%DEBT%' THEN 'CRISIL_GILT'
  ELSE 'NIFTY100' END AS tracking_benchmark FROM {x_funds}""",
    "x_cagr": """
SELECT amfi_code, {cagr1} AS cagr_1y_pct, {cagr3} AS cagr_3y_pct, {cagr5} AS cagr_5y_pct FROM (
  SELECT n.amfi_code, any_value(e.last_day) AS e_day, max_by(n.nav, n.date) AS e_nav,
    max(n.date) FILTER (n.date <= last_day - INTERVAL 1 YEAR) AS d1, max_by(n.nav, n.date) FILTER (n.date <= last_day - INTERVAL 1 YEAR) AS v1,
    max(n.date) FILTER (n.date <= last_day - INTERVAL 3 YEAR) AS d3, max_by(n.nav, n.date) FILTER (n.date <= last_day - INTERVAL 3 YEAR) AS v3,
    max(n.date) FILTER (n.date <= last_day - INTERVAL 5 YEAR) AS d5, max_by(n.nav, n.date) FILTER (n.date <= last_day - INTERVAL 5 YEAR) AS v5
  FROM {x_nav} n JOIN (SELECT amfi_code, max(date) AS last_day FROM {x_nav} GROUP BY amfi_code) e ON n.amfi_code = e.amfi_code
  GROUP BY n.amfi_code) t""",
    "x_drawdown": """
SELECT d.amfi_code, t.dd * 100 AS max_drawdown_pct, t.peak_day AS drawdown_start_date, t.date AS drawdown_trough_date,
  min(d.date) FILTER (d.date > t.date AND d.nav >= t.peak) AS drawdown_recovery_date
FROM {x_nav} d JOIN (
  SELECT amfi_code, date, peak, dd, (SELECT min(p.date) FROM {x_nav} p WHERE p.amfi_code = q.amfi_code AND p.nav = q.peak AND p.date <= q.date) AS peak_day
  FROM (SELECT amfi_code, date, peak, dd, row_number() OVER (PARTITION BY amfi_code ORDER BY dd, date) AS pos FROM (
    SELECT amfi_code, date, nav / max(nav) OVER w - 1 AS dd, max(nav) OVER w AS peak FROM {x_nav}
    WINDOW w AS (PARTITION BY amfi_code ORDER BY date ROWS UNBOUNDED PRECEDING)) z) q WHERE pos = 1) t
ON d.amfi_code = t.amfi_code GROUP BY ALL""",
    "x_risk": """
SELECT amfi_code, count(*) AS nav_observations, count(daily_return) AS return_observations,
  min(date) AS start_date, max(date) AS end_date,
  pow(1 + avg(daily_return), 252) - 1 AS ann, stddev_samp(daily_return) * sqrt(252.0) AS vol,
  stddev_samp(daily_return) FILTER (daily_return < 0) * sqrt(252.0) AS downvol,
  min(daily_return) * 100 AS min_daily_return_pct, max(daily_return) * 100 AS max_daily_return_pct,
  avg(daily_return) * 100 AS mean_daily_return_pct, stddev_samp(daily_return) * 100 AS std_daily_return_pct
FROM {x_returns} GROUP BY amfi_code""",
    "x_alpha": """
SELECT amfi_code, CASE WHEN n >= 30 THEN slope END AS beta, CASE WHEN n >= 30 THEN icept END AS alpha_daily,
  CASE WHEN n >= 30 THEN icept * 252 * 100 END AS alpha_annualized_pct, CASE WHEN n >= 30 THEN r2 END AS r_squared,
  n AS regression_observations
FROM (SELECT f.amfi_code, regr_slope(f.daily_return, m.benchmark_return) AS slope,
    regr_intercept(f.daily_return, m.benchmark_return) AS icept, regr_r2(f.daily_return, m.benchmark_return) AS r2,
    CAST(regr_count(f.daily_return, m.benchmark_return) AS BIGINT) AS n
  FROM {x_returns} f LEFT JOIN (SELECT * FROM {x_index_returns} WHERE index_name = 'NIFTY100') m ON f.date = m.date
  GROUP BY f.amfi_code) t""",
    "x_tracking": """
SELECT f.amfi_code, any_value(k.tracking_benchmark) AS tracking_benchmark,
  stddev_samp(f.daily_return - m.benchmark_return) * sqrt(252.0) * 100 AS tracking_error_pct
FROM {x_returns} f JOIN {x_fund_index} k ON f.amfi_code = k.amfi_code
LEFT JOIN {x_index_returns} m ON m.date = f.date AND m.index_name = k.tracking_benchmark GROUP BY f.amfi_code""",
    "x_metrics": """
SELECT r.amfi_code, f.scheme_name, f.fund_house, f.category, f.sub_category, f.benchmark, f.expense_ratio_pct,
  r.start_date, r.end_date, r.nav_observations, r.return_observations, r.ann * 100 AS annualized_return_pct,
  c.cagr_1y_pct, c.cagr_3y_pct, c.cagr_5y_pct, r.vol * 100 AS annualized_volatility_pct,
  CASE WHEN r.vol > 0 THEN (r.ann - 0.065) / r.vol END AS sharpe_ratio,
  CASE WHEN r.downvol > 0 THEN (r.ann - 0.065) / r.downvol END AS sortino_ratio,
  a.alpha_daily, a.alpha_annualized_pct, a.beta, a.r_squared, a.regression_observations, d.max_drawdown_pct,
  d.drawdown_start_date, d.drawdown_trough_date, d.drawdown_recovery_date, r.min_daily_return_pct,
  r.max_daily_return_pct, r.mean_daily_return_pct, r.std_daily_return_pct, t.tracking_benchmark, t.tracking_error_pct
FROM {x_risk} r JOIN {x_funds} f USING (amfi_code) JOIN {x_cagr} c USING (amfi_code) JOIN {x_alpha} a USING (amfi_code)
JOIN {x_drawdown} d USING (amfi_code) JOIN {x_tracking} t USING (amfi_code)""",
    "x_scores": """
SELECT *, coalesce(score_3y_return, 0) + coalesce(score_sharpe, 0) + coalesce(score_alpha, 0)
  + coalesce(score_expense, 0) + coalesce(score_drawdown, 0) AS fund_score
FROM (SELECT *, (n - rank_3y_return + 1) / n * 0.30 * 100 AS score_3y_return, (n - rank_sharpe + 1) / n * 0.25 * 100 AS score_sharpe,
    (n - rank_alpha + 1) / n * 0.20 * 100 AS score_alpha, (n - rank_expense_inverse + 1) / n * 0.15 * 100 AS score_expense,
    (n - rank_max_drawdown_inverse + 1) / n * 0.10 * 100 AS score_drawdown
  FROM (SELECT *, count(*) OVER () AS n,
      CASE WHEN cagr_3y_pct IS NOT NULL THEN rank() OVER (ORDER BY cagr_3y_pct DESC NULLS LAST) END AS rank_3y_return,
      CASE WHEN sharpe_ratio IS NOT NULL THEN rank() OVER (ORDER BY sharpe_ratio DESC NULLS LAST) END AS rank_sharpe,
      CASE WHEN alpha_annualized_pct IS NOT NULL THEN rank() OVER (ORDER BY alpha_annualized_pct DESC NULLS LAST) END AS rank_alpha,
      CASE WHEN expense_ratio_pct IS NOT NULL THEN rank() OVER (ORDER BY expense_ratio_pct NULLS LAST) END AS rank_expense_inverse,
      CASE WHEN max_drawdown_pct IS NOT NULL THEN rank() OVER (ORDER BY max_drawdown_pct DESC NULLS LAST) END AS rank_max_drawdown_inverse
    FROM {x_metrics}) a) b""",
    "x_scorecard": """
SELECT * EXCLUDE (n), row_number() OVER (ORDER BY fund_score DESC, cagr_3y_pct DESC NULLS LAST, sharpe_ratio DESC NULLS LAST,
  alpha_annualized_pct DESC NULLS LAST, scheme_name, amfi_code) AS fund_rank FROM {x_scores}""",
    "s_dim_fund": "SELECT row_number() OVER (ORDER BY amfi_code) AS fund_key, * FROM {x_funds}",
    "s_dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
  CAST(month(d) AS INT) AS month, monthname(d) AS month_name, CAST(day(d) AS INT) AS day, CAST(isodow(d) - 1 AS INT) AS day_of_week,
  dayname(d) AS day_name, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN d = last_day(d) THEN 1 ELSE 0 END AS is_month_end
FROM (SELECT launch_date AS d FROM {x_funds} UNION SELECT date FROM {x_nav} UNION SELECT transaction_date FROM {x_txn}
  UNION SELECT date FROM {x_aum}) u WHERE d IS NOT NULL""",
    "s_fact_nav": """
SELECT f.fund_key, CAST(strftime(n.date, '%Y%m%d') AS INT) AS date_key, n.nav FROM {x_nav} n JOIN {s_dim_fund} f USING (amfi_code)""",
    "s_fact_txn": """
SELECT f.fund_key, CAST(strftime(t.transaction_date, '%Y%m%d') AS INT) AS date_key, t.* EXCLUDE (amfi_code, transaction_date)
FROM {x_txn} t JOIN {s_dim_fund} f USING (amfi_code)""",
    "x_flagged": """
SELECT *, concat_ws(';', CASE WHEN expense_ratio_pct < 0.1 OR expense_ratio_pct > 2.5 THEN 'expense_ratio_out_of_range' END,
  CASE WHEN sharpe_ratio > 3 THEN 'high_sharpe_ratio' END,
  CASE WHEN abs(sharpe_ratio - return_3yr_pct) <= 1e-8 + 1e-5 * abs(return_3yr_pct) THEN 'sharpe_matches_return_3yr' END,
  CASE WHEN sortino_ratio > 5 THEN 'high_sortino_ratio' END, CASE WHEN max_drawdown_pct > 0 THEN 'positive_max_drawdown' END,
  CASE WHEN abs(return_1yr_pct) > 50 THEN 'extreme_return_1yr' END, CASE WHEN beta < 0 OR beta > 2 THEN 'beta_out_of_range' END,
  CASE WHEN morningstar_rating < 1 OR morningstar_rating > 5 THEN 'invalid_morningstar_rating' END) AS anomaly_flag FROM {x_perf}""",
    "s_fact_perf": """
SELECT f.fund_key, p.return_1yr_pct, p.return_3yr_pct, p.return_5yr_pct, p.benchmark_3yr_pct, p.alpha, p.beta, p.sharpe_ratio,
  p.sortino_ratio, p.std_dev_ann_pct, p.max_drawdown_pct, p.aum_crore, p.expense_ratio_pct, p.morningstar_rating, p.risk_grade,
  nullif(p.anomaly_flag, '') AS anomaly_flag FROM {x_flagged} p JOIN {s_dim_fund} f USING (amfi_code)""",
    "s_fact_aum": """
SELECT CAST(strftime(date, '%Y%m%d') AS INT) AS date_key, fund_house, aum_lakh_crore, aum_crore, num_schemes FROM {x_aum}""",
    "x_indexed": """
SELECT n.amfi_code, n.date, n.nav, n.nav / b.nav * 100 AS indexed FROM {x_nav} n
LEFT JOIN (SELECT amfi_code, nav FROM {x_nav} WHERE date = (SELECT min(date) FROM {x_nav})) b USING (amfi_code)""",
    "x_avg_indexed": "SELECT date, avg(indexed) AS avg_indexed_nav FROM {x_indexed} GROUP BY date",
    "x_top10": """
SELECT amfi_code, row_number() OVER (ORDER BY aum_crore DESC, amfi_code) AS slot FROM {x_perf}
ORDER BY aum_crore DESC, amfi_code LIMIT 10""",
    "x_corr": """
SELECT a.slot AS slot_a, b.slot AS slot_b, a.amfi_code AS code_a, b.amfi_code AS code_b, corr(a.r, b.r) AS correlation
FROM (SELECT t.slot, x.amfi_code, x.date, x.daily_return AS r FROM {x_returns} x JOIN {x_top10} t USING (amfi_code)) a
JOIN (SELECT t.slot, x.amfi_code, x.date, x.daily_return AS r FROM {x_returns} x JOIN {x_top10} t USING (amfi_code)) b ON a.date = b.date
WHERE a.date IN (SELECT x.date FROM {x_returns} x JOIN {x_top10} t USING (amfi_code) WHERE x.daily_return IS NOT NULL GROUP BY x.date HAVING count(*) = 10)
GROUP BY ALL""",
    "x_year_aum": """
SELECT year, fund_house, aum_lakh_crore FROM (SELECT CAST(year(date) AS INT) AS year, fund_house, aum_lakh_crore,
  row_number() OVER (PARTITION BY year(date), fund_house ORDER BY date DESC) AS pos FROM {x_aum}) t WHERE pos = 1""",
    "x_sectors": """
SELECT sector, sum(weight_pct) AS weight_pct FROM {x_holdings}
WHERE amfi_code IN (SELECT amfi_code FROM {x_funds} WHERE category = 'Equity') GROUP BY sector""",
    "x_sectors9": """
SELECT CASE WHEN pos <= 9 THEN sector ELSE 'Others' END AS sector, sum(weight_pct) AS weight_pct
FROM (SELECT sector, weight_pct, row_number() OVER (ORDER BY weight_pct DESC, sector) AS pos FROM {x_sectors}) t GROUP BY 1""",
}
for _n in (1, 3, 5):
    ORACLE_ONLY["x_cagr"] = ORACLE_ONLY["x_cagr"].replace(
        f"{{cagr{_n}}}",
        f"CASE WHEN d{_n} IS NOT NULL AND v{_n} > 0 AND date_diff('day', d{_n}, e_day) / 365.25 >= 0.95 * {_n} THEN "
        f"(pow(e_nav / v{_n}, 365.25 / date_diff('day', d{_n}, e_day)) - 1) * 100 END")

_NAME = re.compile(r"\{(\w+)\}")
_ORACLE = ADAPTERS | ORACLE_ONLY


def _ordered_inputs(sql: str, seen: dict[str, str]) -> None:
    for name in _NAME.findall(sql):
        if name not in seen and name in _ORACLE:
            _ordered_inputs(_ORACLE[name], seen)
            seen[name] = _ORACLE[name]


def oracle_text(sql: str) -> str:
    """A self-contained query: the adapters it needs as common table expressions."""
    needed: dict[str, str] = {}
    _ordered_inputs(sql, needed)
    plain = {name: _NAME.sub(r"\1", text).strip() for name, text in needed.items()}
    body = _NAME.sub(r"\1", sql).strip()
    if not plain:
        return body
    if body.upper().startswith("WITH "):
        body = f"SELECT * FROM ({body}) result"
    tables = ",\n".join(f"{name} AS ({text})" for name, text in plain.items())
    return f"WITH {tables}\n{body}"


class Tables:
    """Lazy DataFrames by adapter name for one session and data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def _make(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            return table.hint("merge") if name in EXCHANGED else table
        if name in ADAPTERS:
            sql = ADAPTERS[name]
            return self.spark.sql(sql, **{n: getattr(self, n) for n in set(_NAME.findall(sql))})
        return getattr(self, f"_make_{name}")()

    def _make_x_nav(self):
        return fill_calendar(self.x_nav_raw, "amfi_code", "date", "nav")

    def _make_x_flagged(self):
        return self.x_perf.withColumn("anomaly_flag", anomaly_flags())

    def _make_x_returns(self):
        return returns.daily_returns(self.x_nav)

    def _make_x_returns_named(self):
        return returns.daily_returns(self.x_nav, self.x_funds)

    def _make_x_index_returns(self):
        return returns.benchmark_returns(self.x_index)

    def _make_x_metrics(self):
        return returns.fund_metrics(self.x_nav, self.x_funds, self.x_index_returns)

    def with_stored(self, name: str) -> Tables:
        """The same tables, made from one written copy of ``name``: every use of it would join and every range sort sample it anew."""
        path = scratch_path(self.spark, name)
        getattr(self, name).write.parquet(path)
        other = Tables(self.spark, self.folder)
        other._made[name] = self.spark.read.parquet(path)
        return other

    @contextmanager
    def with_ordered(self, name: str, key: str, wanted: Iterable[str]) -> Iterator[Tables]:
        """The ``wanted`` tables, made from one copy of ``name`` that is kept in the order of ``key``: those that call the key ``ingest_seq`` are in its order without an exchange.

        They are made before the copy is kept: the views by which SQL gets its inputs, when dropped, forget what was kept of them.
        """
        other = Tables(self.spark, self.folder)
        other._made[name] = kept = getattr(self, name).orderBy(key)
        for each in wanted:
            getattr(other, each)
        # Small slices of a kept table are put together only if this is set when it is first planned.
        with setting(self.spark, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true"):
            kept.persist()
            kept.count()  # made once, before several jobs ask for it
        try:
            yield other
        finally:
            kept.unpersist()

    def star(self) -> dict[str, DataFrame]:
        """The written warehouse; built on first use, as the reporting queries expect."""
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _STARS:
            _STARS[key] = warehouse.build(
                self.spark, scratch_path(self.spark, "warehouse"), self.x_funds, self.x_nav, self.x_aum,
                self.x_flagged, self.x_txn)
        return _STARS[key]

    def scorecard(self) -> DataFrame:
        return scorecard.scorecard(self.x_metrics)


#: The written star of each (application, folder): stored files, the only thing that queries share.
_STARS: dict[tuple[str, str], dict[str, DataFrame]] = {}


def tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(spark, folder)
