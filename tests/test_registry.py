"""Each registered query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from workload import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Streams take long to start; their logic is also covered in the other tests.
STREAMS = ["read_stream_raw", "interval_join_stream", "left_stream_join_stream", "order_pre_process_stream",
           "dim_app_stream", "cart_add_new_code_stream", "base_log_stream", "user_jump_stream",
           "left_left_join_stream", "order_refund_stream", "refund_pay_suc_stream", "comment_stream",
           "full_stream_join_upsert_stream", "full_stream_join_stream", "late_data_stream", "repair_is_new_stream",
           "order_refund_new_code_stream", "comment_new_code_stream"]
BATCH = sorted(n for n in registry.QUERIES if not n.endswith("_stream") and n != "read_stream_raw")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", BATCH + STREAMS)
def test_query(spark, duck, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    result = duck.execute(contract.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)
    assert len(got) == len(expected) and got == expected


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
