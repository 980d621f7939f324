"""Driver contract: entry runs, every query has an oracle or is rows-only,
and a sample of queries matches DuckDB on sf0.001."""

import os

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001

def own(names):
    """The queries of the warehouse itself."""
    return {n for n in names if not n.startswith("op") or not n[2:3].isdigit()} - {"pipeline"}


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["user_type", "job_level", "number_of_orders", "total_revenue"]
    assert df.count() > 0


def test_registry():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert own(q) == own(o)


@pytest.mark.parametrize("name", ["customer_segment_revenue", "merchant_performance", "dim_date",
                                  "clean_user_job", "dedup_order", "scd2_merge", "broadcast_index_join",
                                  "dq_order_thresholds", "html_table_scan"])
def test_oracle_sample(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from tools.oracle_check import digest
    con = duckdb.connect()
    for t in ["customer", "supplier", "part", "orders", "lineitem", "nation", "region", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF0001, t)}.parquet')")
    sdf = E.queries()[name](spark, SF0001)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert digest(sdf.columns, [tuple(r) for r in sdf.collect()])[0] == digest(dcols, cur.fetchall())[0]
