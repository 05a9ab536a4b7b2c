"""Publishing the star as a whole: versions beside each other, checks as a gate, one pointer moved last.

Overwriting six tables one after the other shows readers a mixture, and a load that fails half-way leaves it there.
Here every load is written to a folder of its own, ``<root>/versions/<name>``, checked there (row counts against the sources and
declared rules), and becomes current by one rename of the small file ``<root>/CURRENT``. Readers open the version that file
names. A load that fails, in writing or at the gate, changes nothing that readers see.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from fundlake.plans import warehouse
from fundlake.sources.files import read_table

POINTER = "CURRENT"
TABLES = ("dim_fund", "dim_date", "fact_nav", "fact_transactions", "fact_performance", "fact_aum")
#: Rules whose violations are reported, not held against a load: these sources have gaps there.
REPORTED_ONLY = frozenset({("fact_transactions", "not null: gender"), ("fact_performance", "check: morningstar_rating")})


class GateFailed(RuntimeError):
    """A load that was written but not published."""


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _store(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, root: str) -> str | None:
    """The name of the version that readers see; None before the first publication."""
    pointer = _path(spark, root, POINTER)
    store = _store(spark, pointer)
    if not store.exists(pointer):
        return None
    stream = store.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _point_to(spark: SparkSession, root: str, version: str) -> None:
    """Write the pointer beside its place, then put it there by one rename that replaces the old one."""
    fresh, pointer = _path(spark, root, f"{POINTER}.{version}"), _path(spark, root, POINTER)
    stream = _store(spark, fresh).create(fresh, True)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = getattr(jvm, "Options$Rename").OVERWRITE
    jvm.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, pointer, options)


def open_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the current version. They stay the same, whatever is published later."""
    version = current(spark, root)
    if version is None:
        raise FileNotFoundError(f"Nothing is published in: {root}")
    return {name: read_table(spark, f"{root}/versions/{version}/{name}") for name in TABLES}


def check_gate(sources: Mapping[str, DataFrame], tables: Mapping[str, DataFrame], reported_only: Iterable[tuple[str, str]] = REPORTED_ONLY) -> DataFrame:
    """``(table, rule, violations)`` of what stands against publishing these tables; no rows: nothing does."""
    allowed = set(reported_only)
    broken = [tuple(r) for r in warehouse.check_constraints(tables).where("violations > 0").collect() if (r.table, r.rule) not in allowed]
    for row in warehouse.compare_row_counts(sources, tables).where("status <> 'OK'").collect():
        broken.append((row.table_name, f"row count: {row.source_rows} in the source", abs(row.source_rows - row.table_rows)))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(broken, "table STRING, rule STRING, violations BIGINT")


def publish(
    spark: SparkSession, root: str, funds: DataFrame, nav: DataFrame, aum: DataFrame, performance: DataFrame,
    transactions: DataFrame, reported_only: Iterable[tuple[str, str]] = REPORTED_ONLY,
) -> str:
    """Build, check and publish the star; the name of the new version. ``GateFailed`` if a check fails: the old one stays current."""
    version = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    tables = warehouse.build(spark, f"{root}/versions/{version}", funds, nav, aum, performance, transactions)
    sources = {"dim_fund": funds, "fact_nav": nav, "fact_transactions": transactions, "fact_performance": performance, "fact_aum": aum}
    against = check_gate(sources, tables, reported_only).collect()
    if against:
        raise GateFailed(f"Version {version} is not published: " + "; ".join(f"{r.table}, {r.rule}: {r.violations}" for r in against))
    _point_to(spark, root, version)
    return version


def versions(spark: SparkSession, root: str) -> list[str]:
    """All versions that are stored, the oldest first, published or not."""
    folder = _path(spark, root, "versions")
    store = _store(spark, folder)
    return sorted(entry.getPath().getName() for entry in store.listStatus(folder)) if store.exists(folder) else []


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete versions older than the current one but for the ``keep`` newest of them; the names that went."""
    now = current(spark, root)
    older = [name for name in versions(spark, root) if now is not None and name < now]
    gone = older[: max(len(older) - keep, 0)]
    for name in gone:
        path = _path(spark, root, "versions", name)
        _store(spark, path).delete(path, True)
    return gone
