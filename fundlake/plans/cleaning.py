"""The ten dataset cleaning pipelines.

A pipeline parses text into types, rejects rows by an ordered list of rules,
keeps one row per key and finishes the types. Rows are kept by a conjunction of
one-column predicates: the optimizer derives constraints from them one by one,
where a single predicate over many parsed columns would cost it 2^columns steps.
The same rules, in order, give the dropped-row count of every rule in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake import schemas as S
from fundlake.functions.coerce import (
    existing,
    iso_date,
    lenient_double,
    lenient_long,
    month_start,
    standardise,
    strict_long,
    strip,
)
from fundlake.functions.rules import anomaly_flags, expense_in_range
from fundlake.operators.aggregates import beside
from fundlake.operators.constraints import required
from fundlake.operators.dedup import distinct_rows, keep_last
from fundlake.operators.series import fill_calendar
from fundlake.session import brief_shuffles
from fundlake.sources.files import read_csv, write_csv

REJECT = "__reject"
#: Files that are cleaned at the same time: sorts, samples and single-task stages of one leave cores to the others.
AT_ONCE = 4
Rules = Sequence[tuple[str, Column]]


def positive(*names: str) -> Column:
    """All named columns above zero; a missing value does not pass."""
    return reduce(and_, [F.col(name) > 0 for name in names])


def present(*names: str) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in names])


def tag_rejects(df: DataFrame, rules: Rules) -> DataFrame:
    """Add the name of the first rule each row breaks, NULL when it passes all."""
    broken = [F.when(~F.coalesce(keep, F.lit(False)), F.lit(name)) for name, keep in rules]
    return df.withColumn(REJECT, F.coalesce(*broken, F.lit(None).cast("string")))


def accepted(df: DataFrame, rules: Rules) -> DataFrame:
    return df.where(reduce(and_, [keep for _, keep in rules]))


@dataclass(frozen=True)
class Pipeline:
    file: str
    columns: Sequence[str]
    parse: Callable[[DataFrame], DataFrame]
    rules: Callable[[], Rules]
    finish: Callable[[DataFrame], DataFrame]
    order: Sequence[str]
    output: Sequence[str]
    dates: Sequence[str] = ()
    months: Sequence[str] = ()

    def clean(self, raw: DataFrame) -> DataFrame:
        return existing(self.finish(accepted(self.parse(raw), self.rules())), self.output)

    def rejects(self, raw: DataFrame) -> DataFrame:
        """``(rule, dropped)`` for every rule, zero included."""
        tagged = tag_rejects(self.parse(raw), self.rules())
        counts = tagged.agg(F.array(*[
            F.struct(F.lit(name).alias("rule"), F.count_if(F.col(REJECT) == name).alias("dropped"))
            for name, _ in self.rules()
        ]).alias("r"))
        return counts.select(F.inline("r"))


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: lenient_double(name) for name in names})


def _stripped(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: strip(name) for name in names})


# Whole-number columns are tested as doubles and cut to integers at the end, from
# a copy parsed without going through double, so large codes stay exact.

def _parse_fund_master(raw: DataFrame) -> DataFrame:
    df = raw.withColumns({"amfi_code": lenient_long("amfi_code"), "launch_date": iso_date("launch_date")})
    df = _doubles(df, "expense_ratio_pct", "exit_load_pct", "min_sip_amount", "min_lumpsum_amount")
    return _stripped(df, "plan", "fund_house", "scheme_name", "category", "sub_category", "benchmark",
                     "fund_manager", "risk_category", "sebi_category_code")


def _finish_fund_master(df: DataFrame) -> DataFrame:
    df = df.withColumns({c: F.col(c).cast("long") for c in ("min_sip_amount", "min_lumpsum_amount")})
    return keep_last(df, ["amfi_code"])


def _parse_nav(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"date": iso_date("date"), "nav": lenient_double("nav")})


def _finish_nav(df: DataFrame) -> DataFrame:
    """Dedup first, then test the price: a bad last duplicate removes its day."""
    df = df.withColumn("amfi_code", strict_long("amfi_code"))
    daily = keep_last(df, ["amfi_code", "date"]).where(F.col("nav") > 0)
    return fill_calendar(daily, "amfi_code", "date", "nav")


def _parse_aum(raw: DataFrame) -> DataFrame:
    df = _doubles(raw, "aum_lakh_crore", "aum_crore", "num_schemes")
    return _stripped(df.withColumn("date", iso_date("date")), "fund_house")


def _finish_aum(df: DataFrame) -> DataFrame:
    df = df.withColumns({c: F.col(c).cast("long") for c in ("aum_crore", "num_schemes")})
    return keep_last(df, ["date", "fund_house"])


_SIP_NUMBERS = S.MONTHLY_SIP_INFLOWS[1:5]


def _parse_sip(raw: DataFrame) -> DataFrame:
    return _doubles(raw.withColumn("month", month_start("month")), *_SIP_NUMBERS, "yoy_growth_pct")


def _finish_sip(df: DataFrame) -> DataFrame:
    return keep_last(df.withColumn("sip_inflow_crore", F.col("sip_inflow_crore").cast("long")), ["month"])


def _parse_category(raw: DataFrame) -> DataFrame:
    df = _doubles(raw.withColumn("month", month_start("month")), "net_inflow_crore")
    return _stripped(df, "category")


def _parse_folios(raw: DataFrame) -> DataFrame:
    return _doubles(raw.withColumn("month", month_start("month")), *S.INDUSTRY_FOLIO_COUNT[1:])


def _parse_performance(raw: DataFrame) -> DataFrame:
    return _doubles(raw.withColumn("amfi_code", lenient_long("amfi_code")), *S.PERFORMANCE_METRICS)


def _finish_performance(df: DataFrame) -> DataFrame:
    """Flag anomalies; an expense ratio out of range fails the run."""
    one = keep_last(df, ["amfi_code"]).withColumn("anomaly_flag", anomaly_flags())
    checked = required(one, expense_in_range(F.col("expense_ratio_pct")), "expense_ratio_pct out of range")
    return checked.withColumns({
        "morningstar_rating": F.col("morningstar_rating").cast("long"),
        "aum_crore": F.col("aum_crore").cast("long"),
    })


def _parse_transactions(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "transaction_type": standardise("transaction_type", S.TRANSACTION_SPELLINGS),
        "amount_inr": lenient_double("amount_inr"),
        "transaction_date": iso_date("transaction_date"),
        "kyc_status": standardise("kyc_status", S.KYC_SPELLINGS),
        "annual_income_lakh": lenient_double("annual_income_lakh"),
    })


def _finish_transactions(df: DataFrame) -> DataFrame:
    typed = df.withColumns({"amount_inr": F.col("amount_inr").cast("long"), "amfi_code": strict_long("amfi_code")})
    return distinct_rows(typed)


def _parse_holdings(raw: DataFrame) -> DataFrame:
    df = raw.withColumns({"amfi_code": lenient_long("amfi_code"), "portfolio_date": iso_date("portfolio_date")})
    return _stripped(_doubles(df, "weight_pct", "market_value_cr", "current_price_inr"), "stock_symbol", "stock_name", "sector")


def _parse_indices(raw: DataFrame) -> DataFrame:
    df = _doubles(raw.withColumn("date", iso_date("date")), "close_value")
    return _stripped(df, "index_name")


PIPELINES: Mapping[str, Pipeline] = {
    "fund_master": Pipeline(
        "01_fund_master.csv", S.FUND_MASTER, _parse_fund_master,
        lambda: [
            ("amfi_code missing", present("amfi_code")),
            ("launch_date invalid", present("launch_date")),
            ("expense_ratio_pct invalid", expense_in_range(F.col("expense_ratio_pct"))),
            ("minimum amount invalid", positive("min_sip_amount", "min_lumpsum_amount")),
            ("plan invalid", F.col("plan").isin(*S.PLANS)),
        ],
        _finish_fund_master, ["amfi_code"], S.FUND_MASTER, dates=["launch_date"],
    ),
    "nav_history": Pipeline(
        "02_nav_history.csv", S.NAV_HISTORY, _parse_nav,
        lambda: [("date invalid", present("date"))],
        _finish_nav, ["amfi_code", "date"], S.NAV_HISTORY, dates=["date"],
    ),
    "aum_by_fund_house": Pipeline(
        "03_aum_by_fund_house.csv", S.AUM_BY_FUND_HOUSE, _parse_aum,
        lambda: [
            ("date invalid", present("date")),
            ("AUM metric invalid", positive("aum_lakh_crore", "aum_crore", "num_schemes")),
        ],
        _finish_aum, ["date", "fund_house"], S.AUM_BY_FUND_HOUSE, dates=["date"],
    ),
    "monthly_sip_inflows": Pipeline(
        "04_monthly_sip_inflows.csv", S.MONTHLY_SIP_INFLOWS, _parse_sip,
        lambda: [("month invalid", present("month")), ("SIP metric invalid", positive(*_SIP_NUMBERS))],
        _finish_sip, ["month"], S.MONTHLY_SIP_INFLOWS, months=["month"],
    ),
    "category_inflows": Pipeline(
        "05_category_inflows.csv", S.CATEGORY_INFLOWS, _parse_category,
        lambda: [("month invalid", present("month")), ("net_inflow_crore invalid", present("net_inflow_crore"))],
        lambda df: keep_last(df, ["month", "category"]), ["month", "category"], S.CATEGORY_INFLOWS, months=["month"],
    ),
    "industry_folio_count": Pipeline(
        "06_industry_folio_count.csv", S.INDUSTRY_FOLIO_COUNT, _parse_folios,
        lambda: [("month invalid", present("month")), ("folio metric invalid", positive(*S.INDUSTRY_FOLIO_COUNT[1:]))],
        lambda df: keep_last(df, ["month"]), ["month"], S.INDUSTRY_FOLIO_COUNT, months=["month"],
    ),
    "scheme_performance": Pipeline(
        "07_scheme_performance.csv", S.SCHEME_PERFORMANCE, _parse_performance,
        lambda: [("amfi_code missing", present("amfi_code")), ("metric not numeric", present(*S.PERFORMANCE_METRICS))],
        _finish_performance, ["amfi_code"], (*S.SCHEME_PERFORMANCE, "anomaly_flag"),
    ),
    "investor_transactions": Pipeline(
        "08_investor_transactions.csv", S.INVESTOR_TRANSACTIONS, _parse_transactions,
        lambda: [
            ("transaction_type invalid", present("transaction_type")),
            ("amount_inr invalid", positive("amount_inr")),
            ("transaction_date invalid", present("transaction_date")),
            ("kyc_status invalid", present("kyc_status")),
        ],
        _finish_transactions, ["transaction_date", "investor_id", "amfi_code"], S.INVESTOR_TRANSACTIONS,
        dates=["transaction_date"],
    ),
    "portfolio_holdings": Pipeline(
        "09_portfolio_holdings.csv", S.PORTFOLIO_HOLDINGS, _parse_holdings,
        lambda: [
            ("amfi_code missing", present("amfi_code")),
            ("portfolio_date invalid", present("portfolio_date")),
            ("holding metric invalid", positive("weight_pct", "market_value_cr", "current_price_inr")),
        ],
        lambda df: keep_last(df, ["amfi_code", "portfolio_date", "stock_symbol"]),
        ["amfi_code", "portfolio_date", "-weight_pct"], S.PORTFOLIO_HOLDINGS, dates=["portfolio_date"],
    ),
    "benchmark_indices": Pipeline(
        "10_benchmark_indices.csv", S.BENCHMARK_INDICES, _parse_indices,
        lambda: [("date invalid", present("date")), ("close_value invalid", positive("close_value"))],
        lambda df: keep_last(df, ["date", "index_name"]), ["index_name", "date"], S.BENCHMARK_INDICES, dates=["date"],
    ),
}


def clean(dataset: str, raw: DataFrame) -> DataFrame:
    return PIPELINES[dataset].clean(raw)


def reject_counts(dataset: str, raw: DataFrame) -> DataFrame:
    return PIPELINES[dataset].rejects(raw)


def sort_columns(pipeline: Pipeline) -> list[Column]:
    return [
        F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_last()
        for name in pipeline.order
    ]


def run_one(spark: SparkSession, dataset: str, raw_folder: str, out_folder: str) -> DataFrame:
    """Clean one file into ``out_folder``; returns ``(dataset, raw_rows, clean_rows)``.

    The counts are queries over the source and the written file. Metrics observed
    during the write would count rows of repeated tasks twice.
    """
    step = PIPELINES[dataset]
    source, target = f"{raw_folder}/{step.file}", f"{out_folder}/{step.file}"
    raw = read_csv(spark, source, step.columns)
    write_csv(step.clean(raw).orderBy(*sort_columns(step)), target, step.dates, step.months)
    written = read_csv(spark, target, step.output)
    counts = beside(raw.agg(F.count("*").alias("raw_rows")), written.agg(F.count("*").alias("clean_rows")))
    return counts.select(F.lit(dataset).alias("dataset"), "raw_rows", "clean_rows")


def run_all(spark: SparkSession, raw_folder: str, out_folder: str) -> DataFrame:
    """Clean every file; one row each, in the order of ``PIPELINES``."""
    with brief_shuffles(spark), ThreadPoolExecutor(AT_ONCE) as pool:
        rows = pool.map(lambda dataset: run_one(spark, dataset, raw_folder, out_folder), PIPELINES)
        return reduce(DataFrame.unionByName, rows)
