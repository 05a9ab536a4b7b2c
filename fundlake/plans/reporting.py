"""The ten reporting queries over the star schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlake.functions.rules import pct_of
from fundlake.operators.aggregates import sum_if

Star = Mapping[str, DataFrame]


def _rated_funds(star: Star) -> DataFrame:
    """Performance snapshot with the fund's descriptive columns."""
    funds = star["dim_fund"].select("fund_key", "amfi_code", "scheme_name", "fund_house", "sub_category", "plan")
    return star["fact_performance"].join(funds, "fund_key")


def _by_month(facts: DataFrame, star: Star) -> DataFrame:
    """Facts with year and month of their date key; the calendar is small by nature."""
    days = star["dim_date"].select("date_key", "year", "month")
    return facts.join(F.broadcast(days), "date_key")


def largest_funds(star: Star, n: int = 5) -> DataFrame:
    rated = _rated_funds(star).select("amfi_code", "scheme_name", "fund_house", "aum_crore")
    return rated.orderBy(F.desc("aum_crore"), F.asc("amfi_code")).limit(n)


def monthly_average_nav(star: Star) -> DataFrame:
    monthly = _by_month(star["fact_nav"], star).groupBy("year", "month")
    return monthly.agg(F.round(F.avg("nav"), 4).alias("avg_nav")).orderBy("year", "month")


def sip_growth(star: Star) -> DataFrame:
    """Monthly instalments against the same month a year earlier."""
    sip = star["fact_transactions"].where(F.col("transaction_type") == "SIP")
    monthly = _by_month(sip, star).groupBy("year", "month").agg(
        F.sum("amount_inr").alias("sip_amount"), F.count("*").alias("sip_txn_count"))
    earlier = monthly.select(
        (F.col("year") + 1).alias("year"), "month",
        F.col("sip_amount").alias("amount_before"), F.col("sip_txn_count").alias("count_before"))
    joined = monthly.join(earlier, ["year", "month"], "left")
    return joined.select(
        "year", "month", "sip_amount", "sip_txn_count",
        F.round(pct_of(F.col("sip_amount") - F.col("amount_before"), F.col("amount_before")), 2).alias("yoy_sip_amount_pct"),
        F.round(pct_of(F.col("sip_txn_count") - F.col("count_before"), F.col("count_before")), 2).alias("yoy_sip_count_pct"),
    ).orderBy("year", "month")


def transactions_by_state(star: Star) -> DataFrame:
    states = star["fact_transactions"].groupBy("state").agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount_inr").cast("double").alias("total_amount_inr"),
        F.round(F.avg("amount_inr"), 2).alias("avg_ticket_size_inr"))
    return states.orderBy(F.desc("total_amount_inr"), F.desc("transaction_count"))


def low_cost_funds(star: Star, below: float = 1.0) -> DataFrame:
    cheap = _rated_funds(star).where(F.col("expense_ratio_pct") < below)
    return cheap.select(
        "amfi_code", "scheme_name", "fund_house", "plan", "expense_ratio_pct", "return_3yr_pct", "sharpe_ratio",
    ).orderBy(F.asc("expense_ratio_pct"), F.desc("return_3yr_pct"))


def alpha_leaders(star: Star, n: int = 10) -> DataFrame:
    excess = F.round(F.col("return_3yr_pct") - F.col("benchmark_3yr_pct"), 2)
    return _rated_funds(star).select(
        "amfi_code", "scheme_name", "fund_house", "return_3yr_pct", "benchmark_3yr_pct",
        excess.alias("excess_return_3yr_pct"), "alpha", "sharpe_ratio",
    ).orderBy(F.desc("alpha"), F.desc("excess_return_3yr_pct"), F.asc("amfi_code")).limit(n)


def sharpe_leaders(star: Star) -> DataFrame:
    """Funds with the best Sharpe ratio of their sub-category, ties kept.

    The best value per sub-category is a partial aggregate; joining it back never
    gathers a sub-category in one task the way a rank window would.
    """
    rated = _rated_funds(star)
    best = rated.groupBy("sub_category").agg(F.max("sharpe_ratio").alias("best_sharpe"))
    leaders = rated.join(best, "sub_category").where(F.col("sharpe_ratio") == F.col("best_sharpe"))
    return leaders.select(
        "sub_category", "scheme_name", "fund_house", "sharpe_ratio", "sortino_ratio", "std_dev_ann_pct",
    ).orderBy("sub_category")


def net_flow(star: Star) -> DataFrame:
    """Money in, money out and the month-over-month change of the difference.

    The change is divided by the signed flow before, so its sign flips after a
    month of net outflow. The window runs over one row per month.
    """
    incoming = F.col("transaction_type").isin("SIP", "Lumpsum")
    outgoing = F.col("transaction_type") == "Redemption"
    monthly = _by_month(star["fact_transactions"], star).groupBy("year", "month").agg(
        sum_if(incoming, F.col("amount_inr")).alias("gross_inflow"),
        sum_if(outgoing, F.col("amount_inr")).alias("redemption"))
    monthly = monthly.withColumn("net_flow", F.col("gross_inflow") - F.col("redemption"))
    before = F.lag("net_flow").over(Window.orderBy("year", "month"))
    return monthly.withColumn("__before", before).select(
        "year", "month", "gross_inflow", "redemption", "net_flow",
        F.round(pct_of(F.col("net_flow") - F.col("__before"), F.col("__before")), 2).alias("mom_net_flow_change_pct"),
    ).orderBy("year", "month")


def concentration(star: Star) -> DataFrame:
    """Herfindahl-Hirschman index and largest share on the latest reporting date."""
    aum = star["fact_aum"]
    latest = aum.where(F.col("date_key") == aum.select(F.max("date_key")).scalar())
    # sum of squared shares = sum(x^2) / sum(x)^2: one aggregate, no window.
    x = F.col("aum_crore").cast("double")
    sums = latest.agg(F.sum(x * x).alias("squares"), F.sum(x).alias("total"), F.max(x).alias("largest"))
    return sums.select(
        F.round(F.col("squares") / (F.col("total") * F.col("total")) * 10000, 2).alias("hhi_index"),
        F.round(F.col("largest") / F.col("total") * 100, 2).alias("largest_fund_house_share_pct"))


def city_tier_behaviour(star: Star) -> DataFrame:
    segments = star["fact_transactions"].groupBy("city_tier", "transaction_type").agg(
        F.count("*").alias("txn_count"),
        F.sum("amount_inr").cast("double").alias("total_amount_inr"),
        F.round(F.avg("amount_inr"), 2).alias("avg_ticket_size_inr"),
        F.countDistinct("investor_id").alias("__investors"))
    ratio = F.round(F.col("__investors") / F.col("txn_count"), 4)
    return segments.withColumn("unique_investor_ratio", ratio).drop("__investors").orderBy(
        F.asc("city_tier"), F.desc("total_amount_inr"))
