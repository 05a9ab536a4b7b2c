"""How often queries read their sources and how often they shuffle, counted in the plans that ran."""

import os
import threading

import pytest

import __spark_entry__ as contract_entry
from contract.tables import Tables
from fundlake.operators import constraints
from fundlake.plans import cleaning, quality, warehouse
from fundlake.sources import files
from tools.executed import broadcast_rows, executed_nodes

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

#: Driver tables that each query's adapters name, counted with repeats: one evaluation reads so many.
SOURCES = {"w7_share_over_all": 4, "e6_latest_aum_share": 4, "a25_share_of_total": 4, "e12_gender_split": 4, "e14_city_tier_sip": 4, "l4_top_n_and_others": 5, "e18_sector_weights": 5}


@pytest.mark.parametrize("name", SOURCES)
def test_shares_and_remainders_read_their_sources_once(spark, name):
    assert executed_nodes(contract_entry.queries()[name](spark, FOLDER))["FileSourceScanExec"] == SOURCES[name]


def test_a_profile_is_one_scan_and_one_shuffle_of_row_identities(spark, tmp_path):
    spark.range(3000).selectExpr("cast(id % 700 as string) AS a", "repeat('x', 500) AS b").write.parquet(str(tmp_path / "t"))
    report = quality.profile_table("t", spark.read.parquet(str(tmp_path / "t")))
    nodes = executed_nodes(report)
    assert nodes["FileSourceScanExec"] == 1 and nodes["ShuffleExchangeExec"] == 2  # the second brings one row a task together
    assert [(r.column, r.dtype, r.rows, r.duplicates) for r in report.collect()] == [("a", "int64", 3000, 2300), ("b", "str", 3000, 2300)]


def test_profile_of_many_columns_nulls_and_shifted_values(spark):
    """More columns than a mask holds; rows whose values are equal but stand in other columns differ."""
    names = [f"c{i}" for i in range(130)]
    rows = [tuple("1" if i == k % 130 else None for i in range(130)) for k in range(131)]
    report = {r.column: r for r in quality.profile_table("t", spark.createDataFrame(rows, ", ".join(f"{n} STRING" for n in names))).collect()}
    assert len(report) == 130 and all(r.duplicates == 1 and r.rows == 131 for r in report.values())
    assert report["c0"].nulls == 129 and {report[n].nulls for n in names[1:]} == {130} and report["c77"].dtype == "float64"


def test_all_key_rules_share_one_exchange(spark, tmp_path):
    for name, n in (("dim", 40), ("fact", 300), ("other", 50)):
        spark.range(n).selectExpr("id % 45 AS k", "id AS d", f"CASE WHEN id % 10 <> 0 THEN '{name}' || id END AS t").write.parquet(str(tmp_path / name))
    tables = {name: spark.read.parquet(str(tmp_path / name)) for name in ("dim", "fact", "other")}
    rules = {
        "dim": constraints.TableRules(unique=[["k"], ["t"]]),
        "fact": constraints.TableRules(not_null=("t",), unique=[["k", "d"], ["t"], ["k"]], foreign={"k": "dim"}),
        "other": constraints.TableRules(unique=[["k"]], foreign={"k": "dim"}),
    }
    report = constraints.all_violations(tables, rules)
    found = {(r.table, r.rule): r.violations for r in report.collect()}
    assert found == {
        ("dim", "unique: k"): 0, ("dim", "unique: t"): 0, ("fact", "not null: t"): 30, ("fact", "unique: k, d"): 0, ("fact", "unique: t"): 0,
        ("fact", "unique: k"): 255, ("fact", "foreign key: k -> dim"): sum(i % 45 >= 40 for i in range(300)),
        ("other", "unique: k"): 5, ("other", "foreign key: k -> dim"): 5}
    nodes = executed_nodes(report)
    # Keys by hash, sums by space, the row rules' sums: not one per rule.
    assert nodes["ShuffleExchangeExec"] <= 4 and nodes["FileSourceScanExec"] == 4
    empty = {name: table.limit(0) for name, table in tables.items()}
    assert {r.violations for r in constraints.all_violations(empty, rules).collect()} == {0}
    assert constraints.all_violations(empty, rules).count() == 9


def test_fund_keys_and_customers_do_not_pass_the_driver(spark, tmp_path):
    """Small compressed columns hide many rows from the planner; such tables are exchanged, not broadcast."""
    funds = spark.range(2000).selectExpr("id AS amfi_code", "id + 1 AS fund_key")
    nav = spark.range(5000).selectExpr("CASE WHEN id % 7 > 0 THEN id % 2100 END AS amfi_code", "DATE '2020-01-01' AS date", "CAST(id AS DOUBLE) AS nav")
    facts = warehouse.fact_nav(nav, funds)
    nodes = executed_nodes(facts)
    assert nodes["BroadcastExchangeExec"] == 0 and nodes["SortMergeJoinExec"] == 1
    assert facts.count() == nav.where("amfi_code < 2000").count()

    spark.range(5).selectExpr("CAST(id AS INT) AS r_regionkey", "'R' || id AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    spark.range(25).selectExpr("CAST(id AS INT) AS n_nationkey", "'N' || id AS n_name", "CAST(id % 5 AS INT) AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(900).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey", "CAST(id AS DOUBLE) AS c_acctbal", "'BUILDING' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(3000).selectExpr(
        "id AS o_orderkey", "id % 1000 AS o_custkey", "'F' AS o_orderstatus", "CAST(id AS DOUBLE) AS o_totalprice",
        "TIMESTAMP '1998-01-01 00:00:00' AS o_orderdate", "'1-URGENT' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    orders = Tables(spark, str(tmp_path)).x_orders
    nodes = executed_nodes(orders)
    assert nodes["SortMergeJoinExec"] == 1 and nodes["BroadcastExchangeExec"] == 2  # nations and regions, whose number is fixed
    assert orders.count() == 2700


def test_all_files_are_cleaned_several_at_a_time(spark, monkeypatch):
    """Two files must be under way at once to pass the barrier; the report keeps the order of the pipelines."""
    barrier = threading.Barrier(2)

    def one(spark, dataset, raw_folder, out_folder):
        barrier.wait(20)
        return spark.range(1).selectExpr(f"'{dataset}' AS dataset")

    monkeypatch.setattr(cleaning, "run_one", one)
    assert [r.dataset for r in cleaning.run_all(spark, "raw", "clean").collect()] == list(cleaning.PIPELINES)


def test_reading_csv_parts_starts_no_python_workers(spark, tmp_path):
    spark.range(40).selectExpr("CAST(id AS STRING) AS k").repartitionByRange(4, "k").write.option("header", True).csv(f"{tmp_path}/t.csv")
    rows = files.read_csv(spark, f"{tmp_path}/t.csv")
    nodes = executed_nodes(rows)
    assert nodes["BroadcastExchangeExec"] == 1 and nodes["RDDScanExec"] == 0
    assert len({r.ingest_seq for r in rows.collect()}) == 40


@pytest.mark.parametrize("name", ["r_nav", "r_txn", "r_index"])
def test_raw_tables_of_a_run_share_one_copy_of_the_orders(spark, name):
    made = getattr(Tables(spark, FOLDER).with_stored("x_orders"), name)
    nodes = executed_nodes(made)
    assert nodes["FileSourceScanExec"] == (2 if name == "r_txn" else 1) and not any("Join" in kind for kind in nodes)


def test_rows_broadcast_by_the_star_and_its_transaction_queries_do_not_grow(spark, tmp_path, monkeypatch):
    """Five times the customers, parts and orders on the same days: as many rows pass the driver as before."""
    write_table = warehouse.write_table

    def passed(size):
        folder = f"{tmp_path}/{size}"
        spark.range(5).selectExpr("CAST(id AS INT) AS r_regionkey", "'R' || id AS r_name").write.parquet(f"{folder}/region.parquet")
        spark.range(25).selectExpr("CAST(id AS INT) AS n_nationkey", "'N' || id AS n_name", "CAST(id % 5 AS INT) AS n_regionkey").write.parquet(f"{folder}/nation.parquet")
        spark.range(200 * size).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey", "CAST(id AS DOUBLE) AS c_acctbal", "'BUILDING' AS c_mktsegment").write.parquet(f"{folder}/customer.parquet")
        # Funds are launched on a day by their code; these share one.
        spark.range(100 * size).selectExpr(
            "id * 3000 AS p_partkey", "'P' || id AS p_name", "'B' AS p_brand", "'T' AS p_type", "CAST(id % 50 AS INT) AS p_size",
            "CAST(id + 1 AS DOUBLE) AS p_retailprice").write.parquet(f"{folder}/part.parquet")
        spark.range(3000 * size).selectExpr(
            "id AS o_orderkey", f"id % {220 * size} AS o_custkey", "substring('FOP', CAST(id % 3 AS INT) + 1, 1) AS o_orderstatus", "CAST(id + 1 AS DOUBLE) AS o_totalprice",
            "TIMESTAMP '1997-01-01 00:00:00' + make_dt_interval(CAST(id % 60 AS INT)) AS o_orderdate", "'1-URGENT' AS o_orderpriority").write.parquet(f"{folder}/orders.parquet")
        rows = {}

        def write(df, path):
            rows[path.rsplit("/", 1)[1]] = broadcast_rows(df)
            write_table(df, path)

        monkeypatch.setattr(warehouse, "write_table", write)
        facts = Tables(spark, folder).star()["fact_transactions"].count()
        queries = contract_entry.queries()
        for name in ("w12_fact_transactions", "qy3_sql", "k12_month_over_month", "qy10_sql"):
            rows[name] = broadcast_rows(queries[name](spark, folder))
        return rows, facts

    (small, few), (large, many) = passed(1), passed(5)
    assert set(small) >= {"dim_fund", "dim_date", "fact_nav", "fact_transactions", "fact_performance", "fact_aum"}
    assert few == sum(i % 220 < 200 for i in range(3000)) and many == sum(i % 1100 < 1000 for i in range(15000))
    assert large == small
