import os
import sys

import duckdb
import pytest

import __spark_entry__ as contract_entry
from contract.registry import CHECKS
from contract.tables import DRIVER_TABLES
from tools.compare import rows_of

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ("qy8_net_flow", "k1_gap_fill", "m10_fund_metrics", "c8_clean_transactions", "e11_sip_amount_boxes", "w8_min_rank", "m13_final_ranking")


def test_every_query_has_a_twin():
    assert set(CHECKS) <= set(contract_entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_twin(spark, name):
    db = duckdb.connect()
    for table in DRIVER_TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    df = contract_entry.queries()[name](spark, FOLDER)
    twin = db.sql(contract_entry.oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of(twin.columns, twin.fetchall())


def test_the_rest_works_without_the_training_data_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(contract_entry.queries()) == set(CHECKS) and set(contract_entry.oracle_sql()) <= set(CHECKS)
