"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import SMALL, entry, oracle_sql, queries
from checks import all_queries
from checks.compare import duck, rows_of

# These write a folder per date or month and take minutes on a local disk; RUN_SLOW=1 runs them.
SLOW = {
    "external_tables",
    "ctas_partitioned",
    "batch_run",
    "batch_run_stopped",
    "batch_run_twice",
    "warehouse_load",
    "warehouse_rejects",
}
slow = pytest.mark.skipif(not os.environ.get("RUN_SLOW"), reason="slow, set RUN_SLOW=1")
QUERIES = {name: run for name, run in queries().items() if name in all_queries()}
SQL = oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["pickup_borough", "trips", "revenue"]
    assert df.count() == 5


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize(
    "name", [pytest.param(n, marks=slow) if n in SLOW else n for n in QUERIES if n in SQL]
)
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())
