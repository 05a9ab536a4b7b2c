"""Data-quality profile of raw tables and key reconciliation."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.functions.coerce import is_number, is_whole_number
from fundlake.operators.aggregates import MASK_BITS, beside, masks, row_identity
from fundlake.operators.dedup import distinct_values
from fundlake.operators.sets import reconcile_keys
from fundlake.sources.files import scan_folder

PROFILE_SCHEMA = (
    "file STRING, column STRING, position INT, dtype STRING, nulls BIGINT, rows BIGINT, "
    "duplicates BIGINT, note STRING, error STRING"
)


def profile_table(name: str, raw: DataFrame) -> DataFrame:
    """One row per column: inferred type, missing values, table size and duplicates.

    ``int64`` when every value is a whole number and none is missing, ``float64``
    when every present value is a number, ``str`` otherwise: the types a text
    reader with inference would settle on.

    One scan and one shuffle: of each different row its identity, the flags of its values and its copies.
    """
    data = raw.drop("ingest_seq")
    values = [F.col(f"`{c}`") for c in data.columns]
    identity = row_identity(data.columns)
    parts = {f"__id{i}": part for i, part in enumerate(identity)}
    # Equal rows have equal flags, so these go along with the row's identity.
    kinds = {"nulls": identity[2:], "not_whole": masks([~is_whole_number(v) for v in values]), "not_number": masks([~is_number(v) for v in values])}
    parts |= {f"__{kind}{i}": part for kind in ("not_whole", "not_number") for i, part in enumerate(kinds[kind])}
    places = {"nulls": [f"__id{i + 2}" for i in range(len(identity) - 2)], **{kind: [f"__{kind}{i}" for i in range(len(kinds[kind]))] for kind in ("not_whole", "not_number")}}
    different = data.select(*[part.alias(name) for name, part in parts.items()]).groupBy(*parts).agg(F.count("*").alias("__n"))

    def flagged(kind: str, at: int) -> Column:
        bit = F.col(places[kind][at // MASK_BITS]).bitwiseAND(F.lit(1 << at % MASK_BITS))
        return F.coalesce(F.sum(F.when(bit != 0, F.col("__n"))), F.lit(0)).alias(kind)

    facts = [F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"), *[flagged(kind, i) for kind in places]) for i, c in enumerate(data.columns)]
    one = different.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"), F.array(*facts).alias("c"))
    dtype = (
        F.when((F.col("not_whole") == 0) & (F.col("nulls") == 0), "int64")
        .when(F.col("not_number") == 0, "float64").otherwise("str"))
    tidy = one.select("rows", "duplicate_rows", F.inline("c"))
    notes = F.concat_ws(
        "; ", F.when(F.col("duplicate_rows") > 0, "duplicate rows"), F.when(F.col("nulls") > 0, "missing values"))
    return tidy.select(
        F.lit(name).alias("file"), "column", "position", dtype.alias("dtype"), "nulls", "rows",
        F.col("duplicate_rows").alias("duplicates"), notes.alias("note"), F.lit(None).cast("string").alias("error"))


def profile(spark: SparkSession, tables: Mapping[str, DataFrame], failures: Mapping[str, str] | None = None) -> DataFrame:
    """Profiles of all tables; tables that could not be read appear with their error."""
    failed = [(name, *[None] * 7, reason) for name, reason in (failures or {}).items()]
    report = spark.createDataFrame(failed, PROFILE_SCHEMA)
    for name, raw in tables.items():
        report = report.unionByName(profile_table(name, raw))
    return report


def profile_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Profile every CSV of a folder; a file that fails while being read is recorded.

    Rows (one per column of a file) are kept by the driver.
    """
    tables, failures = scan_folder(spark, folder)
    rows, left = [], [{name: table} for name, table in tables.items()]
    # All files in one job; where it fails, file by file, to find the ones that cannot be read.
    for some in [tables, *left] if tables else []:
        try:
            rows = [*rows, *(tuple(row) for row in profile(spark, some).collect())]
        except (PySparkException, Py4JError) as problem:
            if some is not tables:
                failures[next(iter(some))] = str(problem).splitlines()[0]
        else:
            if some is tables:
                break
    rows += [(name, *[None] * 7, reason) for name, reason in failures.items()]
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def inventory(report: DataFrame) -> DataFrame:
    """Files found and files loaded."""
    return report.agg(
        F.countDistinct("file").alias("files_found"),
        F.countDistinct(F.when(F.col("error").isNull(), F.col("file"))).alias("files_loaded"))


def explore_master(funds: DataFrame) -> DataFrame:
    """Distinct houses, categories, sub-categories and risk classes."""
    return distinct_values(funds, ["fund_house", "category", "sub_category", "risk_category"])


def sample_codes(funds: DataFrame, n: int = 10) -> DataFrame:
    return funds.select("amfi_code").orderBy("amfi_code").limit(n)


def reconcile(funds: DataFrame, nav: DataFrame) -> DataFrame:
    """Codes in the master without prices (missing) and priced codes not in it (extra)."""
    return reconcile_keys(funds, nav, "amfi_code")


def quality_summary(spark: SparkSession, tables: Mapping[str, DataFrame], master: str, prices: str) -> DataFrame:
    """One-row record of sizes, duplicates, missing values and key mismatches."""
    report = profile(spark, tables)

    def pick(name: str, column: str, how):
        return how(F.when(F.col("file") == name, F.col(column)))

    facts = report.agg(
        F.countDistinct("file").alias("files_analysed"),
        pick(master, "rows", F.max).alias("master_rows"), pick(prices, "rows", F.max).alias("nav_rows"),
        pick(master, "duplicates", F.max).alias("master_duplicates"), pick(prices, "duplicates", F.max).alias("nav_duplicates"),
        pick(master, "nulls", F.sum).alias("master_nulls"), pick(prices, "nulls", F.sum).alias("nav_nulls"))
    keys = reconcile(tables[master], tables[prices]).agg(
        F.count_if(F.col("side") == "missing").alias("missing_codes"),
        F.count_if(F.col("side") == "extra").alias("extra_codes"))
    return beside(facts, keys)


def report_lines(report: DataFrame) -> DataFrame:
    """The profile as text, one line per column or unreadable file."""
    line = F.when(
        F.col("error").isNull(),
        F.format_string("%s: %s %s, %s missing of %s rows", "file", "column", "dtype", "nulls", "rows"),
    ).otherwise(F.concat(F.lit("Error reading "), F.col("file"), F.lit(": "), F.col("error")))
    return report.orderBy("file", "position").select(line.alias("value"))


def markdown_lines(spark: SparkSession, tables: Mapping[str, DataFrame], master: str, prices: str, title: str = "Data quality summary") -> DataFrame:
    """The quality summary as markdown, one line per row and in order: sizes, duplicates, missing values, keys on one side only.

    The key lists are as long as the mismatches are; they are sorted with the other lines, not gathered.
    """
    facts = quality_summary(spark, tables, master, prices)
    c = F.col

    def line(at: int, value) -> Column:
        return F.struct(F.lit(at).alias("at"), F.lit("").alias("code"), (value if isinstance(value, Column) else F.lit(value)).alias("value"))

    def counted(label: str, name: str) -> Column:
        return F.concat(F.lit(f"- {label}: **"), c(name).cast("string"), F.lit("**"))

    def keys(at: int, name: str, label: str, none: str) -> Column:
        return line(at, F.when(c(name) == 0, f"- {none}").otherwise(counted(label, name)))

    fixed = facts.select(F.inline(F.array(
        line(1, f"# {title}"), line(2, ""), line(3, "## Datasets"), line(4, counted("Files analysed", "files_analysed")),
        line(5, counted(f"Rows of {master}", "master_rows")), line(6, counted(f"Rows of {prices}", "nav_rows")),
        line(7, ""), line(8, "## Duplicate rows"), line(9, counted(master, "master_duplicates")), line(10, counted(prices, "nav_duplicates")),
        line(11, ""), line(12, "## Missing values"), line(13, counted(master, "master_nulls")), line(14, counted(prices, "nav_nulls")),
        line(15, ""), line(16, "## Codes"), keys(17, "missing_codes", f"Codes of {master} without prices", f"Every code of {master} has prices"),
        keys(19, "extra_codes", f"Priced codes that {master} does not have", f"No priced code is unknown to {master}"))))
    sides = reconcile(tables[master], tables[prices]).select(
        F.when(c("side") == "missing", 18).otherwise(20).alias("at"), "code", F.concat(F.lit("  - "), c("code")).alias("value"))
    return fixed.unionByName(sides).orderBy("at", "code").select("value")
