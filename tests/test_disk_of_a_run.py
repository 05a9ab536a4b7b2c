"""What a run over all files holds on disk while it goes on."""

import gzip
import threading
import time
from pathlib import Path

import pytest

from contract import checks_plans
from contract.tables import Tables
from fundlake.plans import cleaning
from fundlake.session import setting
from fundlake.sources import files
from tools.executed import _run_nodes, executed_nodes


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}


def _written_tables(spark, folder):
    """The driver's tables, a few rows each, keys in no order."""
    spark.range(5).selectExpr("CAST(id AS INT) AS r_regionkey", "'R' || id AS r_name").write.parquet(f"{folder}/region.parquet")
    spark.range(25).selectExpr("CAST(id AS INT) AS n_nationkey", "'N' || id AS n_name", "CAST(id % 5 AS INT) AS n_regionkey").write.parquet(f"{folder}/nation.parquet")
    spark.range(40).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey", "CAST(id AS DOUBLE) AS c_acctbal", "'BUILDING' AS c_mktsegment").write.parquet(f"{folder}/customer.parquet")
    spark.range(30).selectExpr(
        "id AS p_partkey", "'P' || id AS p_name", "'B' || id % 3 AS p_brand", "'T' AS p_type", "CAST(id % 50 + 1 AS INT) AS p_size",
        "CAST(id + 1 AS DOUBLE) AS p_retailprice").write.parquet(f"{folder}/part.parquet")
    spark.range(600).selectExpr(
        "id * 37 % 600 AS o_orderkey", "id % 40 AS o_custkey", "substring('FOP', CAST(id % 3 AS INT) + 1, 1) AS o_orderstatus", "CAST(id + 1 AS DOUBLE) AS o_totalprice",
        "TIMESTAMP '1997-01-01 00:00:00' + make_dt_interval(CAST(id % 60 AS INT)) AS o_orderdate", "'1-URGENT' AS o_orderpriority").write.parquet(f"{folder}/orders.parquet")
    spark.range(900).selectExpr(
        "id * 37 % 600 AS l_orderkey", "id % 30 AS l_partkey", "id % 7 AS l_suppkey", "CAST(id % 4 AS INT) AS l_linenumber", "CAST(id % 9 + 1 AS DOUBLE) AS l_quantity",
        "CAST(id + 1 AS DOUBLE) AS l_extendedprice", "TIMESTAMP '1997-01-01 00:00:00' + make_dt_interval(CAST(id % 60 AS INT)) AS l_shipdate").write.parquet(f"{folder}/lineitem.parquet")
    return Tables(spark, str(folder))


def test_a_run_keeps_no_shuffle_files_of_finished_jobs(spark, tmp_path, monkeypatch):
    """The run's report is not collected yet: nothing it shuffled is still on disk, and the session's setting is as before."""
    monkeypatch.setattr(cleaning, "PIPELINES", {name: cleaning.PIPELINES[name] for name in ("nav_history", "benchmark_indices")})
    raw = spark.range(4000)
    raw.selectExpr("CAST(id % 50 AS STRING) AS amfi_code", "CAST(DATE '2020-01-01' + CAST(id % 80 AS INT) AS STRING) AS date", "CAST(id + 1 AS STRING) AS nav").write.option("header", True).csv(f"{tmp_path}/raw/02_nav_history.csv")
    raw.selectExpr("CAST(DATE '2020-01-01' + CAST(id % 80 AS INT) AS STRING) AS date", "'I' || id % 50 AS index_name", "CAST(id + 1 AS STRING) AS close_value").write.option("header", True).csv(f"{tmp_path}/raw/10_benchmark_indices.csv")
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting_before, before = spark.conf.get(name), _shuffle_files(spark)
    report = cleaning.run_all(spark, f"{tmp_path}/raw", f"{tmp_path}/clean")
    until = time.monotonic() + 20
    while (left := _shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get(name) == setting_before
    # 80 days and 50 names pair up 400 times.
    assert [(r.dataset, r.raw_rows) for r in report.collect()] == [("nav_history", 4000), ("benchmark_indices", 4000)]
    assert report.where("dataset = 'benchmark_indices'").first().clean_rows == 400


def test_a_setting_is_put_back_after_an_error(spark):
    for name in ("spark.sql.shuffle.partitions", "fundlake.no.such.setting"):
        before = spark.conf.get(name, None)
        with pytest.raises(ZeroDivisionError), setting(spark, name, "17"):
            assert spark.conf.get(name) == "17"
            1 / 0
        assert spark.conf.get(name, None) == before


def test_compressed_parts_are_bounded_and_keep_their_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ROWS_A_PART", 7)
    rows = spark.range(100).selectExpr("CAST((id * 37) % 100 AS STRING) AS k", "(id * 37) % 100 AS n", "CASE WHEN id % 5 > 0 THEN ' a\"b,' || id END AS v")
    plain, packed = f"{tmp_path}/plain.csv", f"{tmp_path}/packed.csv"
    files.write_csv(rows.orderBy("n").drop("n"), plain)
    files.write_csv(rows.orderBy("n").drop("n"), packed, compression="gzip")
    parts = list(Path(packed).glob("part-*"))
    assert all(part.name.endswith(".csv.gz") for part in parts) and len(parts) >= 15
    assert max(len(gzip.decompress(part.read_bytes()).splitlines()) for part in parts) == 8  # with the header
    read = [[(r.k, r.v) for r in files.read_csv(spark, path).orderBy("ingest_seq").collect()] for path in (plain, packed)]
    assert read[0] == read[1] and [int(k) for k, _ in read[1]] == list(range(100))


def test_tables_in_the_order_of_the_orders_are_landed_without_an_exchange(spark, tmp_path):
    names = ["r_nav", "r_aum", "r_sip", "r_category", "r_folio", "r_index"]
    made = _written_tables(spark, tmp_path)
    plain = {name: getattr(made, name).orderBy("ingest_seq").collect() for name in names}
    with made.with_ordered("x_orders", "o_orderkey", names) as ordered:
        for name in names:
            rows = getattr(ordered, name).orderBy("ingest_seq")
            assert executed_nodes(rows)["ShuffleExchangeExec"] == 0 and rows.collect() == plain[name]
    assert not made.x_orders.orderBy("o_orderkey").is_cached


def test_raw_files_are_landed_compressed_and_the_widest_alone(spark, tmp_path, monkeypatch):
    under_way, seen, lock, write_csv = set(), {}, threading.Lock(), files.write_csv

    def watched(df, path, *args, **options):
        with lock:
            under_way.add(path)
            for each in under_way:
                seen.setdefault(each, set()).update(under_way)
        write_csv(df, path, *args, **options)
        with lock:
            under_way.discard(path)

    monkeypatch.setattr(files, "write_csv", watched)
    made = _written_tables(spark, tmp_path / "tables")
    folder = checks_plans._land(made, checks_plans._RAW)
    assert len(seen) == 10 and {len(others) for path, others in seen.items() if path.endswith(("08_investor_transactions.csv", "09_portfolio_holdings.csv"))} == {1}
    for dataset, table in checks_plans._RAW.items():
        step = cleaning.PIPELINES[dataset]
        parts = [part.name for part in Path(f"{folder}/{step.file}".removeprefix("file:")).glob("part-*")]
        assert parts and all(part.endswith(".csv.gz") for part in parts)
        landed = files.read_csv(spark, f"{folder}/{step.file}", step.columns).orderBy("ingest_seq").drop("ingest_seq")
        wanted = getattr(made, table).orderBy("ingest_seq").select(*step.columns)
        if dataset in ("fund_master", "scheme_performance", "portfolio_holdings"):
            assert sorted(map(str, landed.collect())) == sorted(map(str, wanted.collect()))
        else:
            assert landed.collect() == wanted.collect()


def test_rows_that_are_exchanged_as_lines_are_written_as_the_same_text(spark, tmp_path):
    odd = [None, "", " a ", 'say "x"', '"', '""', ",", "a,b", "\\", '\\"', "a\\b", "\ttab\t", "#1", "NA", "null", "\u00e9\u4e2d\U0001f600", "'", "1e3", ";", "\x01"]
    rows = spark.createDataFrame([(len(odd) * i + j, a, b) for i, a in enumerate(odd) for j, b in enumerate(odd)], "n INT, a STRING, b STRING").repartition(3, "b")
    rows = rows.selectExpr("n", "a", "b", "DATE '2020-01-01' + n AS d", "n / 7 AS x", "CASE WHEN n % 3 > 0 THEN n % 2 = 0 END AS f")
    columns = ["b", "a", "d", "x", "f"]
    lines = files.in_order(rows, columns, "n")
    exchanges = [node for kind, node in _run_nodes(lines) if kind == "ShuffleExchangeExec" and "rangepartitioning" in node.simpleString(100)]
    assert [node.output().size() for node in exchanges] == [2]
    files.write_csv(rows.orderBy("n").select(*columns).coalesce(1), f"{tmp_path}/wide")
    files.write_csv(lines.coalesce(1), f"{tmp_path}/lines")
    (wide,), (narrow,) = (list(Path(f"{tmp_path}/{name}").glob("part-*")) for name in ("wide", "lines"))
    assert wide.read_bytes() == narrow.read_bytes()
    assert lines.limit(0).count() == 0 and files.in_order(rows.limit(0), columns, "n").count() == 0
