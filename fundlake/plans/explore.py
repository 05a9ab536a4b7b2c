"""The prepared result sets behind the published charts, and the findings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake import schemas as S
from fundlake.functions.rules import in_crore, short_label
from fundlake.operators.aggregates import above_trimmed_ceiling, quantiles, value_counts, with_share
from fundlake.operators.dedup import latest_per_group
from fundlake.operators.ranking import top_n_with_rest
from fundlake.operators.reshape import pivot_grid, unpivot, with_row_total
from fundlake.operators.series import every_kth, growth, highest, lowest, nearest_to_markers, rebase_to_first_day
from fundlake.operators.sets import shared_order
from fundlake.plans.returns import mean_pairwise, return_correlation

# --- fixed values: windows and markers of the published charts -------------------
CORRECTION_WINDOW = ("2024-07-01", "2024-12-31")
SIP_MARKERS = {"All-time high": "2025-12-01", "Jan 2023": "2023-01-01", "Jan 2024": "2024-01-01"}


def nav_trend(nav: DataFrame, funds: DataFrame, step: int = 5) -> DataFrame:
    """Every fifth price of every fund, with fund names."""
    thinned = every_kth(nav.select("amfi_code", "date", "nav"), step, "amfi_code", "nav")
    return thinned.join(funds.select("amfi_code", "scheme_name", "category"), "amfi_code", "left")


def average_indexed_nav(nav: DataFrame) -> DataFrame:
    """Mean over funds of prices indexed to the first day of the table."""
    indexed = rebase_to_first_day(nav, "amfi_code", "nav")
    return indexed.groupBy("date").agg(F.avg("indexed").alias("avg_indexed_nav"))


def category_indexed_nav(nav: DataFrame, funds: DataFrame, category: str | None = None) -> DataFrame:
    """Mean price per category and day, indexed to the first day of the table."""
    named = nav.join(funds.select("amfi_code", "category"), "amfi_code", "left").where(F.col("category").isNotNull())
    mean = named.groupBy("date", "category").agg(F.avg("nav").alias("avg_nav"))
    indexed = rebase_to_first_day(mean, "category", "avg_nav", out="indexed_nav")
    if category:
        indexed = indexed.where(F.col("category") == category)
    return indexed.select("date", "category", "indexed_nav")


def focus_window(average: DataFrame, start: str = CORRECTION_WINDOW[0], end: str = CORRECTION_WINDOW[1]) -> DataFrame:
    return average.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def focus_low(average: DataFrame, start: str = CORRECTION_WINDOW[0], end: str = CORRECTION_WINDOW[1]) -> DataFrame:
    return lowest(focus_window(average, start, end), "avg_indexed_nav")


def yearly_aum(aum: DataFrame) -> DataFrame:
    """Last snapshot of each fund house in each year."""
    dated = aum.where(F.col("fund_house").isNotNull() & F.col("date").isNotNull()).withColumn("year", F.year("date"))
    return latest_per_group(dated, ["year", "fund_house"], F.desc("date")).select("year", "fund_house", "aum_lakh_crore")


def years_in(df: DataFrame, column: str) -> list[int]:
    """The years of a date column, for use as pivot columns."""
    found = df.where(F.col(column).isNotNull()).select(F.year(column).alias("y")).distinct()
    return sorted(row.y for row in found.collect())


def months_in(df: DataFrame, column: str) -> list[str]:
    """The months of a date column as ``yyyy-MM``; at most twelve a year."""
    found = df.where(F.col(column).isNotNull()).select(F.date_format(column, "yyyy-MM").alias("m")).distinct()
    return sorted(row.m for row in found.collect())


def aum_grid(aum: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Fund house by year, absent snapshots 0, largest house of the last year first. A year not in ``years`` fails the query."""
    years = years or years_in(aum, "date")
    snapshots = yearly_aum(aum)
    wide = pivot_grid(snapshots, "fund_house", "year", "aum_lakh_crore", years)
    latest = snapshots.where(F.col("year") == snapshots.select(F.max("year")).scalar()).select("fund_house")
    newest = str(max(years))
    return wide.join(latest, "fund_house", "left_semi").orderBy(F.desc(newest), "fund_house")


def newest_per_house(aum: DataFrame, *values: str) -> DataFrame:
    """The last snapshot of each fund house: date and values, from one aggregate."""
    dated = aum.where(F.col("fund_house").isNotNull() & F.col("date").isNotNull())
    return dated.groupBy("fund_house").agg(F.max(F.struct("date", *values)).alias("s")).select("fund_house", "s.*")


def latest_aum_share(aum: DataFrame) -> DataFrame:
    """Shares of the houses that have a snapshot in the last year.

    A house's last snapshot of that year is its last of all, so the year, the total and the rows all come from one row a house.
    """
    newest = newest_per_house(aum, "aum_lakh_crore")
    latest = newest.where(F.year("date") == newest.select(F.max(F.year("date"))).scalar())
    shares = with_share(latest, "aum_lakh_crore", "share_pct", 100.0).select("fund_house", "aum_lakh_crore", "share_pct")
    return shares.orderBy(F.desc("share_pct"), "fund_house")


def latest_market_share(aum: DataFrame) -> DataFrame:
    """Shares of the houses on the last snapshot day."""
    newest = newest_per_house(aum, "aum_crore")
    latest = newest.where(F.col("date") == newest.select(F.max("date")).scalar())
    return with_share(latest, "aum_crore", "market_share").select("fund_house", "market_share")


def sip_trend(sip: DataFrame) -> DataFrame:
    return sip.select("month", "sip_inflow_crore").orderBy("month")


def sip_markers(sip: DataFrame, markers: Mapping[str, str] = SIP_MARKERS) -> DataFrame:
    """The month closest to each marked day."""
    return nearest_to_markers(sip, markers, "sip_inflow_crore", "month")


def active_accounts(sip: DataFrame) -> DataFrame:
    return sip.select("month", "active_sip_accounts_crore").orderBy("month")


def category_matrix(category: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Category by month, absent cells 0, categories with the largest total first. A repeated cell fails the query."""
    months = months or months_in(category, "month")
    keyed = category.where(F.col("category").isNotNull()).withColumn("__month", F.date_format("month", "yyyy-MM"))
    wide = pivot_grid(keyed, "category", "__month", "net_inflow_crore", months)
    return with_row_total(wide, months).orderBy(F.desc("row_total"), "category")


def category_totals(category: DataFrame) -> DataFrame:
    return category.where(F.col("category").isNotNull()).groupBy("category").agg(F.sum("net_inflow_crore").alias("net_inflow_crore")).orderBy(
        F.desc("net_inflow_crore"), "category")


def age_group_counts(transactions: DataFrame) -> DataFrame:
    """Records per age group in the fixed order; groups without records are absent."""
    return shared_order(value_counts(transactions, "age_group"), "age_group", S.AGE_GROUPS).orderBy("position")


# --- fixed values: box and whisker positions -------------------------------------
BOX_POINTS = {"p5": 0.05, "q1": 0.25, "median": 0.5, "q3": 0.75, "p95": 0.95}


def sip_amount_boxes(transactions: DataFrame) -> DataFrame:
    """Instalment quantiles per age group, after trimming at 1.1 times the 99th percentile."""
    sip = transactions.where(
        (F.col("transaction_type") == "SIP") & F.col("age_group").isin(*S.AGE_GROUPS)
    ).select("age_group", F.col("amount_inr").cast("double").alias("amount_inr"))
    return quantiles(above_trimmed_ceiling(sip, "amount_inr"), "amount_inr", BOX_POINTS, ["age_group"])


def gender_split(transactions: DataFrame) -> DataFrame:
    return with_share(value_counts(transactions, "gender"), "n", "share_pct", 100.0).orderBy(F.desc("n"), "gender")


def _sip_by(transactions: DataFrame, column: str) -> DataFrame:
    sip = transactions.where((F.col("transaction_type") == "SIP") & F.col(column).isNotNull())
    return sip.groupBy(column).agg(F.sum("amount_inr").alias("amount_inr")).withColumn(
        "sip_amount_crore", in_crore(F.col("amount_inr")))


def state_sip(transactions: DataFrame, n: int = 30) -> DataFrame:
    return _sip_by(transactions, "state").orderBy(F.desc("sip_amount_crore"), "state").limit(n)


def city_tier_sip(transactions: DataFrame) -> DataFrame:
    tiers = _sip_by(transactions, "city_tier")
    return with_share(tiers, "amount_inr", "share_pct", 100.0).select("city_tier", "sip_amount_crore", "share_pct")


def folio_trend(folios: DataFrame) -> DataFrame:
    return folios.select("month", "total_folios_crore").orderBy("month")


# --- fixed values: columns and names of the folio mix ----------------------------
FOLIO_PARTS = {
    "Equity": "equity_folios_crore",
    "Debt": "debt_folios_crore",
    "Hybrid": "hybrid_folios_crore",
    "Others": "others_folios_crore",
}


def latest_folio_mix(folios: DataFrame) -> DataFrame:
    """Parts of the latest month, one row each, with their share."""
    newest = folios.agg(F.max(F.struct("month", *FOLIO_PARTS.values())).alias("m"))
    wide = newest.select(F.col("m.month").alias("month"), *[F.col(f"m.{c}").alias(name) for name, c in FOLIO_PARTS.items()])
    tall = unpivot(wide, ["month"], list(FOLIO_PARTS), "part", "folios_crore")
    return with_share(tall, "folios_crore", "share_pct", 100.0)


def largest_by_aum(performance: DataFrame, k: int = 10) -> DataFrame:
    """``(amfi_code, slot)`` of the k largest funds; the slot is the size rank."""
    top = performance.select("amfi_code", "aum_crore").orderBy(F.desc("aum_crore"), "amfi_code").limit(k)
    # k rows: the window above the limit sees no others.
    slot = F.row_number().over(Window.orderBy(F.desc("aum_crore"), F.asc("amfi_code")))
    return top.select("amfi_code", slot.cast("long").alias("slot"))


def labelled_correlation(nav: DataFrame, performance: DataFrame, funds: DataFrame, k: int = 10) -> DataFrame:
    """Correlation matrix of the k largest funds with display labels, in size order."""
    matrix = return_correlation(nav, largest_by_aum(performance, k), k)
    names = funds.select("amfi_code", short_label(F.col("scheme_name")).alias("label"))
    return (
        matrix.join(names.toDF("code_a", "label_a"), "code_a", "left")
        .join(names.toDF("code_b", "label_b"), "code_b", "left")
        .select("slot_a", "slot_b", "label_a", "label_b", "correlation").orderBy("slot_a", "slot_b"))


def sector_weights(holdings: DataFrame, funds: DataFrame, n: int = 9) -> DataFrame:
    """Summed weights per sector over equity funds: the largest n and the rest."""
    equity = funds.where(F.col("category") == "Equity").select("amfi_code")
    sectors = holdings.join(equity, "amfi_code", "left_semi").groupBy("sector").agg(F.sum("weight_pct").alias("weight_pct"))
    return top_n_with_rest(sectors, "sector", "weight_pct", n)


def top_schemes(performance: DataFrame, metric: str, n: int = 10) -> DataFrame:
    return performance.select("amfi_code", "scheme_name", metric).orderBy(
        F.desc_nulls_last(metric), F.asc("amfi_code")).limit(n)


FINDING_COLUMNS = ("finding_no", "metric", "subject", "value")


def _top_groups(transactions: DataFrame) -> DataFrame:
    """``(kind, label, total)`` of the largest age group (records) and the largest state (instalments): one scan, one aggregate."""
    sip_amount = F.when(F.col("transaction_type") == "SIP", F.col("amount_inr"))
    ways = F.array(
        F.struct(F.lit("age").alias("kind"), F.when(F.col("age_group").isin(*S.AGE_GROUPS), F.col("age_group")).alias("label"), F.lit(1).cast("long").alias("amount")),
        F.struct(F.lit("state").alias("kind"), F.when(sip_amount.isNotNull(), F.col("state")).alias("label"), sip_amount.cast("long").alias("amount")))
    totals = transactions.select(F.inline(ways)).where("label IS NOT NULL").groupBy("kind", "label").agg(F.sum("amount").alias("total"))
    top = totals.groupBy("kind").agg(F.min(F.struct((-F.col("total")).alias("t"), F.col("label").alias("l"))).alias("s"))
    return top.select("kind", F.col("s.l").alias("label"), (-F.col("s.t")).alias("total"))


def findings_with_ends(
    aum: DataFrame, sip: DataFrame, category: DataFrame, transactions: DataFrame, folios: DataFrame,
    nav: DataFrame, performance: DataFrame, holdings: DataFrame, funds: DataFrame,
    window: tuple[str, str] = CORRECTION_WINDOW, k: int = 10,
) -> DataFrame:
    """Ten headline facts as ``(finding_no, metric, subject, value, from_value, to_value)``.

    The last two are the first and last value of a growth, where there is one. Facts of one table come from one aggregate over it.
    """
    c = F.col

    def fact(no, metric: str, subject, value, start=None, end=None):
        double = lambda x: (F.lit(None) if x is None else x).cast("double")
        return F.struct(
            F.lit(no).alias("finding_no"), F.lit(metric).alias("metric"), (F.lit(None) if subject is None else subject).cast("string").alias("subject"),
            double(value).alias("value"), double(start).alias("from_value"), double(end).alias("to_value"))

    def told(source: DataFrame, *facts) -> DataFrame:
        return source.select(F.inline(F.array(*facts)))

    newest = newest_per_house(aum, "aum_lakh_crore")
    houses = newest.where(F.year("date") == newest.select(F.max(F.year("date"))).scalar())
    months = sip.agg(
        F.min(F.struct("month", "sip_inflow_crore")).alias("a"),
        F.max(F.struct("month", "sip_inflow_crore", "active_sip_accounts_crore")).alias("b"))
    folio_ends = growth(folios, "total_folios_crore", "month")
    sectors = sector_weights(holdings, funds).agg(F.min(F.struct((-c("weight_pct")).alias("w"), "sector")).alias("t"), F.sum("weight_pct").alias("total"))
    groups = _top_groups(transactions).groupBy().pivot("kind", ["age", "state"]).agg(F.first(F.struct("label", "total")))
    correlations = return_correlation(nav, largest_by_aum(performance, k), k)
    facts = [
        told(highest(houses, "fund_house", "aum_lakh_crore"), fact(1, "largest_amc_aum_lakh_crore", c("fund_house"), c("aum_lakh_crore"))),
        told(months,
             fact(2, "sip_inflow_growth_pct", None, (c("b.sip_inflow_crore") / c("a.sip_inflow_crore") - 1) * 100, c("a.sip_inflow_crore"), c("b.sip_inflow_crore")),
             fact(10, "latest_active_sip_accounts_crore", c("b.month"), c("b.active_sip_accounts_crore"))),
        told(highest(category_totals(category), "category", "net_inflow_crore"), fact(3, "top_category_net_inflow_crore", c("category"), c("net_inflow_crore"))),
        told(groups,
             fact(4, "largest_age_group_records", c("age.label"), c("age.total")),
             fact(5, "top_state_sip_amount_crore", c("state.label"), in_crore(c("state.total")))),
        told(folio_ends, fact(6, "folio_growth_crore", None, c("growth_abs"), c("first_value"), c("last_value"))),
        told(mean_pairwise(correlations), fact(7, "mean_pairwise_correlation", None, c("mean_correlation"))),
        told(sectors, fact(8, "top_sector_share_pct", c("t.sector"), -c("t.w") * 100 / c("total"))),
        told(focus_low(average_indexed_nav(nav), *window), fact(9, "correction_low", c("date"), c("avg_indexed_nav"))),
    ]
    report = facts[0]
    for one in facts[1:]:
        report = report.unionByName(one)
    return report


def findings(*tables: DataFrame, window: tuple[str, str] = CORRECTION_WINDOW, k: int = 10) -> DataFrame:
    """Ten headline facts as ``(finding_no, metric, subject, value)``; tables as in ``findings_with_ends``."""
    return findings_with_ends(*tables, window=window, k=k).select(*FINDING_COLUMNS)


#: This library's own wording of each finding: subject, value, first and last value by position.
_SENTENCES = {
    1: "%1$s is the largest fund house with Rs. %2$.2f lakh crore AUM.",
    2: "Monthly SIP inflows grew %2$.1f%% over the data, from Rs. %3$,.0f crore to Rs. %4$,.0f crore.",
    3: "%1$s recorded the highest cumulative net inflow at Rs. %2$,.0f crore.",
    4: "%1$s is the age group with most transaction records (%2$,.0f).",
    5: "%1$s is the leading SIP state by amount with Rs. %2$,.1f crore.",
    6: "Industry folios increased by %2$.2f crore, from %3$.2f crore to %4$.2f crore.",
    7: "The largest funds show an average pairwise daily return correlation of %2$.2f.",
    8: "%1$s is the largest equity sector at %2$.1f%% of summed weights.",
    9: "%1$s is the local low of the average indexed NAV (%2$.2f).",
    10: "%1$s is the latest month, with %2$.2f crore active SIP accounts.",
}


def finding_sentences(report: DataFrame, title: str | None = None) -> DataFrame:
    """Numbered findings as text lines, of ``findings_with_ends``; below a heading if ``title`` is given."""
    subject = F.coalesce(F.col("subject"), F.lit(""))
    line = F.coalesce(*[
        F.when(F.col("finding_no") == no, F.format_string(f"{no}. {pattern}", subject, F.col("value"), F.col("from_value"), F.col("to_value")))
        for no, pattern in _SENTENCES.items()
    ])
    lines = report.select(F.col("finding_no").alias("at"), line.alias("value"))
    if title:
        heading = report.sparkSession.createDataFrame([(-1, f"# {title}"), (0, "")], "at INT, value STRING")
        lines = heading.unionByName(lines)
    return lines.orderBy("at").select("value")
