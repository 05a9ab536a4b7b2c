"""Checks for sources and sinks, coercion and scalar functions, filters and dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.registry import check
from contract.tables import Tables
from fundlake import schemas as S
from fundlake.functions import calendar as cal
from fundlake.functions import coerce, rules
from fundlake.operators import aggregates, dedup
from fundlake.plans import cleaning, quality, scorecard
from fundlake.session import scratch_path
from fundlake.sources import files

C = F.col


def _raw_columns(df: DataFrame) -> DataFrame:
    return df.drop("ingest_seq")


# --- S: sources and sinks, each as a write followed by a read ----------------------

def _csv_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "scan")
    files.write_csv(_raw_columns(t.r_txn), path)
    return _raw_columns(files.read_csv(t.spark, path, S.INVESTOR_TRANSACTIONS))


check("s1_csv_scan", _csv_scan, "SELECT * EXCLUDE (ingest_seq) FROM {r_txn}")


def _csv_scan_dates(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "scan")
    files.write_csv(_raw_columns(t.r_txn), path)
    df = files.read_csv_with_dates(t.spark, path, ["transaction_date"], S.INVESTOR_TRANSACTIONS)
    return _raw_columns(df)


check("s2_csv_scan_dates", _csv_scan_dates,
      "SELECT * EXCLUDE (ingest_seq) REPLACE (try_cast(transaction_date AS DATE) AS transaction_date) FROM {r_txn}")


def _raw_folder(t: Tables) -> str:
    folder = scratch_path(t.spark, "raw")
    for name, df in {"01_fund_master.csv": t.r_funds, "03_aum_by_fund_house.csv": t.r_aum, "04_monthly_sip_inflows.csv": t.r_sip}.items():
        files.write_csv(_raw_columns(df), f"{folder}/{name}")
    return folder


def _folder_scan(t: Tables) -> DataFrame:
    loaded, _ = files.scan_folder(t.spark, _raw_folder(t))
    report = None
    for name, df in loaded.items():
        row = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("file"), "rows", F.lit(len(df.columns) - 1).alias("columns"))
        report = row if report is None else report.unionByName(row)
    return report


check("s3_folder_scan", _folder_scan, """
SELECT '01_fund_master.csv' AS file, count(*) AS rows, 15 AS columns FROM {r_funds}
UNION ALL SELECT '03_aum_by_fund_house.csv', count(*), 5 FROM {r_aum}
UNION ALL SELECT '04_monthly_sip_inflows.csv', count(*), 6 FROM {r_sip}""")


def _payloads(t: Tables) -> DataFrame:
    """One payload document per series; a series has one entry per day at most."""
    entry = F.struct(F.date_format("date", "dd-MM-yyyy").alias("date"), C("nav").cast("string").alias("nav"))
    grouped = t.x_nav.groupBy("amfi_code").agg(F.collect_list(entry).alias("data"))
    meta = F.struct(C("amfi_code").alias("scheme_code"), F.concat(F.lit("Scheme "), C("amfi_code")).alias("scheme_name"))
    return grouped.select(F.to_json(F.struct(meta.alias("meta"), "data")).alias("body"))


check("s5_nav_payload", lambda t: files.payload_rows(_payloads(t)),
      "SELECT amfi_code AS scheme_code, date, nav FROM {x_nav}")


def _payload_files(t: Tables) -> DataFrame:
    landing = scratch_path(t.spark, "landing")
    files.write_text(_payloads(t).repartition("body"), landing)
    rows = files.payload_rows(t.spark.read.text(landing).withColumnRenamed("value", "body"))
    return files.tag_schemes(rows, {f"Scheme_{n}": n for n in range(25)})


check("s5_landed_payload_tagged", _payload_files, """
SELECT amfi_code AS scheme_code, date, nav, 'Scheme_' || CAST(amfi_code AS VARCHAR) AS scheme_name FROM {x_nav}""")


def _csv_sink(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sink")
    dated = t.x_sip.withColumn("last_day", F.last_day("month")).select("month", "last_day", "sip_inflow_crore")
    files.write_csv(dated, path, dates=["last_day"], months=["month"], order=["month"])
    return _raw_columns(files.read_csv(t.spark, path, ["month", "last_day", "sip_inflow_crore"]))


check("s6_csv_sink", _csv_sink, """
SELECT strftime(month, '%Y-%m') AS month, CAST(last_day(month) AS VARCHAR) AS last_day, CAST(sip_inflow_crore AS VARCHAR) AS sip_inflow_crore FROM {x_sip}""")


def _per_scheme(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "schemes")
    named = t.x_nav.join(t.x_funds.select("amfi_code", "scheme_name"), "amfi_code")
    files.write_per_scheme(named.select("date", "nav", "scheme_name"), path)
    back = t.spark.read.option("header", True).schema("date DATE, nav DOUBLE, scheme_name STRING").csv(path)
    return back.groupBy("scheme_name").agg(F.count("*").alias("rows"), F.max("date").alias("last_date"), F.max("nav").alias("max_nav"))


check("s7_output_per_scheme", _per_scheme, """
SELECT f.scheme_name, count(*) AS rows, max(n.date) AS last_date, max(n.nav) AS max_nav
FROM {x_nav} n JOIN {x_funds} f USING (amfi_code) GROUP BY f.scheme_name""")


def _table_round_trip(t: Tables) -> str:
    path = scratch_path(t.spark, "table")
    files.write_table(t.x_funds, path)
    files.write_table(t.x_funds, path)  # a refresh replaces, it does not append
    return path


check("s8_warehouse_sink", lambda t: files.read_table(t.spark, _table_round_trip(t)), "SELECT * FROM {x_funds}")
check("s9_warehouse_scan", lambda t: files.read_table(t.spark, _table_round_trip(t), ["amfi_code", "scheme_name"]),
      "SELECT amfi_code, scheme_name FROM {x_funds}")


def _result_sink(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "returns")
    files.write_table(t.x_returns_named.withColumn("daily_return_pct", C("daily_return") * 100), path)
    return files.read_table(t.spark, path)


check("s10_result_sink", _result_sink, """
SELECT r.*, f.scheme_name, f.fund_house, f.category, f.sub_category, f.benchmark, f.expense_ratio_pct,
  r.daily_return * 100 AS daily_return_pct FROM {x_returns} r LEFT JOIN {x_funds} f USING (amfi_code)""",
      {"daily_return": 9, "daily_return_pct": 7})

_SUMMARY_SQL = """
SELECT count(DISTINCT amfi_code) AS fund_count, (SELECT count(daily_return) FROM {x_returns}) AS daily_return_rows,
  (SELECT count(*) - count(daily_return) FROM {x_returns}) AS missing_first_return_rows,
  (SELECT min(date) FROM {x_returns}) AS date_min, (SELECT max(date) FROM {x_returns}) AS date_max,
  max(scheme_name) FILTER (fund_rank = 1) AS top_fund, round(max(fund_score) FILTER (fund_rank = 1), 4) AS top_fund_score,
  count(cagr_5y_pct) AS cagr_5y_available_funds FROM {x_scorecard}"""


def _json_sink(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "summary")
    summary = scorecard.run_summary(t.scorecard(), t.x_returns)
    files.write_json(summary, path)
    return t.spark.read.schema(summary.schema).json(path)


check("s11_json_summary_sink", _json_sink, _SUMMARY_SQL, {"top_fund_score": 4})


def _report_sink(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "report")
    files.write_text(quality.report_lines(quality.profile(t.spark, {"sip": t.r_sip})), path)
    return t.spark.read.text(path)


check("s12_quality_report_sink", _report_sink, """
SELECT 'sip: ' || c || ' ' || ty || ', ' || CAST(miss AS VARCHAR) || ' missing of ' || CAST((SELECT count(*) FROM {r_sip}) AS VARCHAR) || ' rows' AS value
FROM (SELECT 'month' AS c, 'str' AS ty, 0 AS miss UNION ALL SELECT 'sip_inflow_crore', 'float64', 0
  UNION ALL SELECT 'active_sip_accounts_crore', 'float64', 0 UNION ALL SELECT 'new_sip_accounts_lakh', 'str', 0
  UNION ALL SELECT 'sip_aum_lakh_crore', 'int64', 0
  UNION ALL SELECT 'yoy_growth_pct', 'float64', (SELECT count(*) FROM {r_sip} WHERE yoy_growth_pct IS NULL)) x""")

# --- T: coercion and scalar functions ---------------------------------------------
_NUMERIC = "regexp_full_match(trim(txt, chr(32) || chr(9) || chr(10)), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')"
_NUMBER = f"CASE WHEN {_NUMERIC} THEN CAST(trim(txt, chr(32) || chr(9) || chr(10)) AS DOUBLE) END"

check("t1_lenient_numeric", lambda t: t.r_numbers.select("o_orderkey", coerce.lenient_double("txt").alias("num")),
      f"SELECT o_orderkey, {_NUMBER} AS num FROM {{r_numbers}}")
check("t2_truncate_to_integer", lambda t: t.r_numbers.select("o_orderkey", coerce.lenient_long("txt").alias("num")),
      f"SELECT o_orderkey, CAST(trunc({_NUMBER}) AS BIGINT) AS num FROM {{r_numbers}}")
check("t3_strict_integer", lambda t: t.r_numbers.select("o_orderkey", coerce.strict_long("code").alias("num")),
      "SELECT o_orderkey, CAST(code AS BIGINT) AS num FROM {r_numbers}")
check("t4_date_parse_drop", lambda t: t.r_dates.select("o_orderkey", coerce.iso_date("txt").alias("d")).where(C("d").isNotNull()),
      "SELECT o_orderkey, try_cast(txt AS DATE) AS d FROM {r_dates} WHERE try_cast(txt AS DATE) IS NOT NULL")
check("t5_month_parse_drop", lambda t: t.r_dates.select("o_orderkey", coerce.month_start("mon").alias("m")).where(C("m").isNotNull()),
      "SELECT o_orderkey, try_cast(mon || '-01' AS DATE) AS m FROM {r_dates} WHERE try_cast(mon || '-01' AS DATE) IS NOT NULL")
check("t6_month_text_to_date", lambda t: t.r_dates.select("o_orderkey", coerce.month_text_to_date(F.date_format("odate", "yyyy-MM")).alias("m")),
      "SELECT o_orderkey, CAST(date_trunc('month', odate) AS DATE) AS m FROM {r_dates}")
check("t7_date_to_text", lambda t: t.r_dates.select("o_orderkey", coerce.iso_text("odate").alias("iso"), coerce.month_text("odate").alias("mon")),
      "SELECT o_orderkey, strftime(odate, '%Y-%m-%d') AS iso, strftime(odate, '%Y-%m') AS mon FROM {r_dates}")
check("t8_whitespace_strip", lambda t: t.r_words.select("p_partkey", coerce.strip("padded").alias("word")),
      "SELECT p_partkey, p_name AS word FROM {part}")
check("t9_header_strip", lambda t: coerce.strip_headers(t.r_words.select(C("p_partkey").alias(" p_partkey "), C("token").alias("token  "))),
      "SELECT p_partkey, token FROM {r_words}")
check("t10_missing_tokens", lambda t: coerce.nulls_for_tokens(t.r_words.select("p_partkey", "token")),
      "SELECT p_partkey, CASE WHEN token IN ('NA', '', 'null', 'None', 'n/a') THEN NULL ELSE token END AS token FROM {r_words}")
check("t11_enum_standardise",
      lambda t: t.r_words.select("p_partkey", coerce.standardise("kind", S.TRANSACTION_SPELLINGS).alias("kind")).where(C("kind").isNotNull()),
      """SELECT p_partkey, CASE p_partkey % 6 WHEN 1 THEN 'SIP' WHEN 2 THEN 'Lumpsum' ELSE 'Redemption' END AS kind
FROM {part} WHERE p_partkey % 6 IN (1, 2, 4)""")
check("t12_empty_to_null", lambda t: t.r_words.select("p_partkey", coerce.empty_to_null("token").alias("token")),
      "SELECT p_partkey, nullif(token, '') AS token FROM {r_words}")
check("t13_date_parts",
      lambda t: t.r_dates.select("o_orderkey", *cal.calendar_columns(C("odate"))).select("o_orderkey", "year", "quarter", "month", "day", "day_of_week"),
      """SELECT o_orderkey, CAST(year(odate) AS INT) AS year, CAST(quarter(odate) AS INT) AS quarter, CAST(month(odate) AS INT) AS month,
CAST(day(odate) AS INT) AS day, CAST(isodow(odate) - 1 AS INT) AS day_of_week FROM {r_dates}""")
check("t14_month_and_day_names",
      lambda t: t.r_dates.select("o_orderkey", *cal.calendar_columns(C("odate"))).select("o_orderkey", "month_name", "day_name"),
      "SELECT o_orderkey, monthname(odate) AS month_name, dayname(odate) AS day_name FROM {r_dates}")
check("t15_weekend_and_month_end",
      lambda t: t.r_dates.select("o_orderkey", cal.is_weekend(C("odate")).alias("is_weekend"), cal.is_month_end(C("odate")).alias("is_month_end")),
      """SELECT o_orderkey, CASE WHEN isodow(odate) > 5 THEN 1 ELSE 0 END AS is_weekend,
CASE WHEN day(odate + 1) = 1 THEN 1 ELSE 0 END AS is_month_end FROM {r_dates}""")
check("t16_date_key", lambda t: t.r_dates.select("o_orderkey", cal.date_key(C("odate")).alias("date_key")),
      "SELECT o_orderkey, CAST(strftime(odate, '%Y%m%d') AS INT) AS date_key FROM {r_dates}")
check("t17_year_offset",
      lambda t: t.r_dates.select("o_orderkey", cal.years_before(C("odate"), 1).alias("y1"), cal.years_before(C("odate"), 3).alias("y3")),
      "SELECT o_orderkey, CAST(odate - INTERVAL 1 YEAR AS DATE) AS y1, CAST(odate - INTERVAL 3 YEAR AS DATE) AS y3 FROM {r_dates}")
check("t18_years_between",
      lambda t: t.r_dates.select("o_orderkey", cal.years_between(F.lit("1990-01-01").cast("date"), C("odate")).alias("years")),
      "SELECT o_orderkey, date_diff('day', DATE '1990-01-01', odate) / 365.25 AS years FROM {r_dates}", {"years": 9})
check("t19_power_and_root",
      lambda t: t.orders.select("o_orderkey", F.pow(C("o_totalprice"), F.lit(0.3)).alias("p"), F.sqrt("o_totalprice").alias("r")),
      "SELECT o_orderkey, pow(o_totalprice, CAST(0.3 AS DOUBLE)) AS p, sqrt(o_totalprice) AS r FROM {orders}", ["p", "r"])
check("t20_close_to", lambda t: t.x_perf.select("amfi_code", rules.close_to(C("sharpe_ratio"), C("return_3yr_pct")).alias("same")),
      "SELECT amfi_code, abs(sharpe_ratio - return_3yr_pct) <= 1e-8 + 1e-5 * abs(return_3yr_pct) AS same FROM {x_perf}")
check("t21_round", lambda t: t.orders.select("o_orderkey", F.round(C("o_totalprice") / 7, 2).alias("x")),
      "SELECT o_orderkey, round(o_totalprice / 7, 2) AS x FROM {orders}")
check("t22_benchmark_rules",
      lambda t: t.r_words.select("p_partkey", rules.benchmark_key(C("benchmark")).alias("key"), rules.benchmark_key(C("benchmark"), strict=True).alias("strict_key")),
      """SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'NIFTY50' WHEN 2 THEN 'NIFTY_MIDCAP150' WHEN 3 THEN 'BSE_SMALLCAP' WHEN 4 THEN 'CRISIL_LIQUID'
WHEN 5 THEN 'CRISIL_GILT' ELSE 'NIFTY100' END AS key, CASE p_partkey % 7 WHEN 0 THEN 'NIFTY500' WHEN 2 THEN 'NIFTY_MIDCAP150' WHEN 3 THEN 'BSE_SMALLCAP'
WHEN 4 THEN 'CRISIL_LIQUID' WHEN 5 THEN 'CRISIL_GILT' ELSE 'NIFTY100' END AS strict_key FROM {part}""")
check("t23_labels",
      lambda t: t.r_words.select("p_partkey", rules.short_label(C("scheme_name")).alias("short"), rules.series_label(C("scheme_name")).alias("legend")),
      """SELECT p_partkey, substring(replace(scheme_name, ' Fund', ''), 1, 18) AS short,
CASE WHEN length(n) > 34 THEN substring(n, 1, 31) || '...' ELSE n END AS legend
FROM (SELECT *, replace(scheme_name, ' Fund - Regular - Growth', '') AS n FROM {r_words}) w""")
check("t24_case_expression",
      lambda t: t.x_txn.select("investor_id", "transaction_date", "amount_inr", F.when(C("transaction_type").isin("SIP", "Lumpsum"), C("amount_inr")).when(C("transaction_type") == "Redemption", -C("amount_inr")).otherwise(0).alias("signed")),
      "SELECT investor_id, transaction_date, amount_inr, CASE transaction_type WHEN 'Redemption' THEN -amount_inr ELSE amount_inr END AS signed FROM {x_txn}")
check("t25_null_safe_division",
      lambda t: t.x_perf.select("amfi_code", rules.ratio(C("return_3yr_pct"), C("sortino_ratio")).alias("q")),
      "SELECT amfi_code, return_3yr_pct / nullif(sortino_ratio, 0) AS q FROM {x_perf}", {"q": 9})
check("t26_unit_scaling", lambda t: t.x_txn.select("investor_id", "transaction_date", rules.in_crore(C("amount_inr")).alias("crore"), (C("annual_income_lakh") * 100).alias("pct")),
      "SELECT investor_id, transaction_date, amount_inr / CAST(10000000 AS DOUBLE) AS crore, annual_income_lakh * 100 AS pct FROM {x_txn}", {"crore": 9, "pct": 6})
check("t27_flag_list", lambda t: t.x_flagged.select("amfi_code", "anomaly_flag"), "SELECT amfi_code, anomaly_flag FROM {x_flagged}")
check("t28_guarded_metric", lambda t: t.x_perf.select("amfi_code", rules.if_positive(C("sharpe_ratio") / F.nullif(C("beta"), F.lit(0.0)), C("beta")).alias("m")),
      "SELECT amfi_code, CASE WHEN beta > 0 THEN sharpe_ratio / beta END AS m FROM {x_perf}", {"m": 9})


def _state_lines(t: Tables) -> DataFrame:
    # Whole amounts, so both engines print the same digits.
    state = t.x_txn.groupBy("state").agg(F.sum("amount_inr").alias("total"), F.count("*").alias("n"))
    return state.select("state", F.format_string("%s: Rs. %,d over %d records", "state", "total", "n").alias("line"))


check("t29_text_rendering", _state_lines, """
SELECT state, state || ': Rs. ' || format('{:,}', CAST(sum(amount_inr) AS BIGINT)) || ' over ' || CAST(count(*) AS VARCHAR) || ' records' AS line
FROM {x_txn} GROUP BY state""")

# --- F: projections and filters ----------------------------------------------------
check("f1_projection", lambda t: t.x_perf.select("scheme_name", "amfi_code", "aum_crore"), "SELECT scheme_name, amfi_code, aum_crore FROM {x_perf}")
check("f2_existing_columns", lambda t: coerce.existing(t.x_perf, ("amfi_code", "scheme_name", "benchmark", "expense_ratio_pct")),
      "SELECT amfi_code, scheme_name, expense_ratio_pct FROM {x_perf}")
check("f3_rename", lambda t: t.x_index.withColumnRenamed("close_value", "level"), "SELECT date, index_name, close_value AS level FROM {x_index}")
check("f4_drop_missing_key", lambda t: t.x_txn.dropna(subset=["gender"]).select("investor_id", "transaction_date", "gender"),
      "SELECT investor_id, transaction_date, gender FROM {x_txn} WHERE gender IS NOT NULL")
check("f5_positive", lambda t: t.x_category.where(cleaning.positive("net_inflow_crore")), "SELECT * FROM {x_category} WHERE net_inflow_crore > 0")
check("f6_all_positive", lambda t: t.x_folio.where(cleaning.positive("equity_folios_crore", "debt_folios_crore", "hybrid_folios_crore")),
      "SELECT * FROM {x_folio} WHERE equity_folios_crore > 0 AND debt_folios_crore > 0 AND hybrid_folios_crore > 0")
check("f7_all_present", lambda t: t.x_txn.where(cleaning.present("gender", "age_group")).select("investor_id", "transaction_date", "gender", "age_group"),
      "SELECT investor_id, transaction_date, gender, age_group FROM {x_txn} WHERE gender IS NOT NULL AND age_group IS NOT NULL")
check("f8_range", lambda t: t.r_funds.select("ingest_seq", coerce.lenient_double("expense_ratio_pct").alias("e")).where(rules.expense_in_range(C("e"))),
      "SELECT ingest_seq, CAST(expense_ratio_pct AS DOUBLE) AS e FROM {r_funds} WHERE CAST(expense_ratio_pct AS DOUBLE) BETWEEN CAST(0.1 AS DOUBLE) AND CAST(2.5 AS DOUBLE)")
check("f9_membership", lambda t: t.r_funds.select("ingest_seq", coerce.strip("plan").alias("plan")).where(C("plan").isin(*S.PLANS)),
      "SELECT ingest_seq, trim(plan) AS plan FROM {r_funds} WHERE trim(plan) IN ('Direct', 'Regular')")
check("f10_equality", lambda t: t.x_txn.where(C("transaction_type") == "SIP").select("investor_id", "transaction_date", "amount_inr"),
      "SELECT investor_id, transaction_date, amount_inr FROM {x_txn} WHERE transaction_type = 'SIP'")
check("f11_codes_from_query", lambda t: t.x_holdings.join(t.x_funds.where(C("category") == "Equity").select("amfi_code"), "amfi_code", "left_semi"),
      "SELECT * FROM {x_holdings} WHERE amfi_code IN (SELECT amfi_code FROM {x_funds} WHERE category = 'Equity')")


def _last_three_years(t: Tables) -> DataFrame:
    end = t.x_index.select(F.max("date")).scalar()
    return t.x_index.where(C("date").between(cal.years_before(end, 3), end))


check("f12_date_range", _last_three_years, """
SELECT * FROM {x_index} WHERE date >= (SELECT CAST(max(date) - INTERVAL 3 YEAR AS DATE) FROM {x_index})""")
check("f13_threshold", lambda t: t.x_perf.where(C("expense_ratio_pct") < 1.0).select("amfi_code", "expense_ratio_pct"),
      "SELECT amfi_code, expense_ratio_pct FROM {x_perf} WHERE expense_ratio_pct < 1")
check("f14_latest_snapshot", lambda t: t.x_aum.where(C("date") == t.x_aum.select(F.max("date")).scalar()),
      "SELECT * FROM {x_aum} WHERE date = (SELECT max(date) FROM {x_aum})")


def _group_best(t: Tables) -> DataFrame:
    best = t.x_perf.groupBy("category").agg(F.max("sharpe_ratio").alias("best"))
    return t.x_perf.join(best, "category").where(C("sharpe_ratio") == C("best")).select("category", "amfi_code", "sharpe_ratio")


check("f15_group_maximum_ties", _group_best, """
SELECT category, amfi_code, sharpe_ratio FROM (SELECT *, rank() OVER (PARTITION BY category ORDER BY sharpe_ratio DESC) AS pos FROM {x_perf}) p WHERE pos = 1""")
check("f16_dropped_rows", lambda t: cleaning.reject_counts("investor_transactions", t.r_txn), """
SELECT rule, count(hit) AS dropped FROM (VALUES ('transaction_type invalid'), ('amount_inr invalid'), ('transaction_date invalid'), ('kyc_status invalid')) r(rule)
LEFT JOIN (SELECT CASE WHEN ingest_seq % 7 IN (4, 5) THEN 'transaction_type invalid' WHEN ingest_seq % 11 IN (0, 1) THEN 'amount_inr invalid'
  WHEN ingest_seq % 13 = 0 THEN 'transaction_date invalid' WHEN ingest_seq % 19 = 0 THEN 'kyc_status invalid' END AS hit FROM {r_txn}) t ON t.hit = r.rule GROUP BY rule""")
check("f17_trim_outliers", lambda t: aggregates.above_trimmed_ceiling(t.orders.select("o_orderkey", (C("o_totalprice") * C("o_totalprice")).alias("v")), "v", 0.9, 1.05),
      """SELECT o_orderkey, o_totalprice * o_totalprice AS v FROM {orders}
WHERE o_totalprice * o_totalprice <= (SELECT quantile_cont(o_totalprice * o_totalprice, 0.9) * 1.05 FROM {orders})""", {"v": 2})

# --- D: dedup ------------------------------------------------------------------------


def _keep_last_sql(table: str, keys: str, extra: str) -> str:
    return (f"SELECT {keys}, {extra} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ingest_seq DESC) AS pos "
            f"FROM {{{table}}}) t WHERE pos = 1")


def _keep_first_sql(table: str, keys: str, extra: str) -> str:
    return _keep_last_sql(table, keys, extra).replace("DESC", "ASC")


def _last(table: str, keys: list[str], extra: list[str]):
    return lambda t: dedup.keep_last(getattr(t, table), keys).select(*keys, *extra)


for _name, _table, _keys, _columns in [
    ("d1_keep_last_code", "r_funds", ["amfi_code"], S.FUND_MASTER),
    ("d2_keep_last_date_house", "r_aum", ["date", "fund_house"], S.AUM_BY_FUND_HOUSE),
    ("d3_keep_last_month", "r_sip", ["month"], S.MONTHLY_SIP_INFLOWS),
    ("d4_keep_last_month_category", "r_category", ["month", "category"], S.CATEGORY_INFLOWS),
    ("d5_keep_last_holding", "r_holdings", ["amfi_code", "portfolio_date", "stock_symbol"], S.PORTFOLIO_HOLDINGS),
    ("d6_keep_last_date_index", "r_index", ["date", "index_name"], S.BENCHMARK_INDICES),
]:
    _extra = [c for c in _columns if c not in _keys]
    check(_name, _last(_table, _keys, _extra), _keep_last_sql(_table, ", ".join(_keys), ", ".join(_extra)))

check("d7_dedup_before_filter",
      lambda t: dedup.keep_last(t.r_nav, ["amfi_code", "date"]).select("amfi_code", "date", coerce.lenient_double("nav").alias("nav")).where(C("nav") > 0),
      "SELECT amfi_code, date, try_cast(nav AS DOUBLE) AS nav FROM (" + _keep_last_sql("r_nav", "amfi_code, date", "nav") + ") u WHERE try_cast(nav AS DOUBLE) > 0")
check("d8_keep_first", lambda t: dedup.keep_first(t.r_nav, ["amfi_code", "date"]).select("amfi_code", "date", "nav"),
      _keep_first_sql("r_nav", "amfi_code, date", "nav"))
check("d8_keep_first_lines", lambda t: dedup.keep_first(t.x_lines, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
      _keep_first_sql("x_lines", "l_orderkey, l_linenumber", "l_partkey, l_suppkey"))
check("d9_full_row_dedup", lambda t: dedup.distinct_rows(t.r_txn), "SELECT DISTINCT * EXCLUDE (ingest_seq) FROM {r_txn}")
check("d10_distinct_dates", lambda t: dedup.distinct_dates((t.x_funds, "launch_date"), (t.x_nav, "date"), (t.x_txn, "transaction_date"), (t.x_aum, "date")),
      "SELECT launch_date AS full_date FROM {x_funds} UNION SELECT date FROM {x_nav} UNION SELECT transaction_date FROM {x_txn} UNION SELECT date FROM {x_aum}")
check("d11_distinct_values", lambda t: dedup.distinct_values(t.x_funds, ["fund_house", "category", "sub_category", "risk_category"]), """
SELECT 'fund_house' AS "column", fund_house AS value FROM {x_funds} UNION SELECT 'category', category FROM {x_funds}
UNION SELECT 'sub_category', sub_category FROM {x_funds} UNION SELECT 'risk_category', risk_category FROM {x_funds}""")
