"""Star schema: two dimensions, four facts, constraints and count checks.

Facts meet their fund's key by a sort-merge join, with skewed fund keys split at run
time. The planner would broadcast the key map while its compressed columns are small,
and so send every fund to the driver once for each fact table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake import schemas as S
from fundlake.functions.calendar import calendar_columns, date_key
from fundlake.functions.coerce import empty_to_null
from fundlake.operators.aggregates import beside
from fundlake.operators.constraints import TableRules, all_violations
from fundlake.operators.dedup import distinct_dates
from fundlake.operators.ranking import row_numbers
from fundlake.sources.files import read_table, write_table


def dim_fund(funds: DataFrame) -> DataFrame:
    """Funds with a dense surrogate key in code order."""
    keyed = row_numbers(funds, [F.col("amfi_code").asc()], "fund_key")
    return keyed.select("fund_key", *funds.columns)


def dim_date(funds: DataFrame, nav: DataFrame, transactions: DataFrame, aum: DataFrame) -> DataFrame:
    """One row per day used by any fact or fund; bounded by the calendar."""
    days = distinct_dates(
        (funds, "launch_date"), (nav, "date"), (transactions, "transaction_date"), (aum, "date"))
    return days.select(*calendar_columns(F.col("full_date")))


def _with_fund_key(facts: DataFrame, funds: DataFrame) -> DataFrame:
    return facts.join(funds.select("amfi_code", "fund_key").hint("merge"), "amfi_code")


def fact_nav(nav: DataFrame, funds: DataFrame) -> DataFrame:
    return _with_fund_key(nav, funds).select("fund_key", date_key(F.col("date")).alias("date_key"), "nav")


def fact_transactions(transactions: DataFrame, funds: DataFrame) -> DataFrame:
    """Facts with a unique (not dense) generated key."""
    kept = [c for c in S.INVESTOR_TRANSACTIONS if c not in ("amfi_code", "transaction_date")]
    return _with_fund_key(transactions, funds).select(
        (F.monotonically_increasing_id() + 1).alias("transaction_key"),
        "fund_key", date_key(F.col("transaction_date")).alias("date_key"), *kept)


def fact_performance(performance: DataFrame, funds: DataFrame) -> DataFrame:
    keyed = _with_fund_key(performance.drop("scheme_name", "fund_house", "category", "plan"), funds)
    return keyed.withColumn("anomaly_flag", empty_to_null("anomaly_flag")).select(
        "fund_key", *S.PERFORMANCE_METRICS, "risk_grade", "anomaly_flag")


def fact_aum(aum: DataFrame) -> DataFrame:
    return aum.select(
        date_key(F.col("date")).alias("date_key"), "fund_house", "aum_lakh_crore", "aum_crore", "num_schemes")


def build(
    spark: SparkSession, folder: str, funds: DataFrame, nav: DataFrame, aum: DataFrame,
    performance: DataFrame, transactions: DataFrame,
) -> dict[str, DataFrame]:
    """Write every table as a full refresh and return the stored tables."""
    def store(name: str, df: DataFrame) -> DataFrame:
        write_table(df, f"{folder}/{name}")
        return read_table(spark, f"{folder}/{name}")

    tables = {"dim_fund": store("dim_fund", dim_fund(funds))}
    fund_map = tables["dim_fund"].select("fund_key", "amfi_code")
    tables["dim_date"] = store("dim_date", dim_date(funds, nav, transactions, aum))
    tables["fact_nav"] = store("fact_nav", fact_nav(nav, fund_map))
    tables["fact_transactions"] = store("fact_transactions", fact_transactions(transactions, fund_map))
    tables["fact_performance"] = store("fact_performance", fact_performance(performance, fund_map))
    tables["fact_aum"] = store("fact_aum", fact_aum(aum))
    return tables


def declared_rules() -> dict[str, TableRules]:
    c = F.col
    return {
        "dim_fund": TableRules(
            not_null=("fund_key", *S.FUND_MASTER), checks={"plan": c("plan").isin(*S.PLANS)},
            unique=[["fund_key"], ["amfi_code"]]),
        "dim_date": TableRules(
            not_null=("date_key", "full_date", "year", "quarter", "month", "month_name", "day", "day_of_week", "day_name"),
            checks={"is_weekend": c("is_weekend").isin(0, 1), "is_month_end": c("is_month_end").isin(0, 1)},
            unique=[["date_key"], ["full_date"]]),
        "fact_nav": TableRules(
            not_null=("fund_key", "date_key", "nav"), checks={"nav": c("nav") > 0},
            unique=[["fund_key", "date_key"]], foreign={"fund_key": "dim_fund", "date_key": "dim_date"}),
        "fact_transactions": TableRules(
            not_null=("transaction_key", "fund_key", "date_key", *[n for n in S.INVESTOR_TRANSACTIONS if n not in ("amfi_code", "transaction_date")]),
            checks={
                "transaction_type": c("transaction_type").isin(*S.TRANSACTION_TYPES),
                "amount_inr": c("amount_inr") > 0,
                "kyc_status": c("kyc_status").isin(*S.KYC_STATUSES),
            },
            unique=[["transaction_key"]], foreign={"fund_key": "dim_fund", "date_key": "dim_date"}),
        "fact_performance": TableRules(
            not_null=("fund_key", *S.PERFORMANCE_METRICS, "risk_grade"),
            checks={"morningstar_rating": c("morningstar_rating").between(1, 5)},
            unique=[["fund_key"]], foreign={"fund_key": "dim_fund"}),
        "fact_aum": TableRules(
            not_null=("date_key", "fund_house"),
            checks={n: c(n) > 0 for n in ("aum_lakh_crore", "aum_crore", "num_schemes")},
            unique=[["date_key", "fund_house"]], foreign={"date_key": "dim_date"}),
    }


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make the star's tables known to ``spark.sql`` under their own names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(prefix + name)


def check_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rule, violations)`` over the whole star."""
    return all_violations(tables, declared_rules())


def compare_row_counts(sources: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, source_rows, table_rows, status)``."""
    report = None
    for name, source in sources.items():
        row = beside(source.agg(F.count("*").alias("source_rows")), tables[name].agg(F.count("*").alias("table_rows")))
        row = row.select(
            F.lit(name).alias("table_name"), "source_rows", "table_rows",
            F.when(F.col("source_rows") == F.col("table_rows"), "OK").otherwise("MISMATCH").alias("status"))
        report = row if report is None else report.unionByName(row)
    return report


def verify_row_counts(sources: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]) -> None:
    wrong = compare_row_counts(sources, tables).where(F.col("status") != "OK").collect()
    if wrong:
        names = ", ".join(f"{r.table_name} ({r.source_rows} vs {r.table_rows})" for r in wrong)
        raise RuntimeError(f"Row count verification failed: {names}")
