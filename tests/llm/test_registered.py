"""The registered queries: all there, and equal to their SQL where they have one."""

import os

import pytest

from __spark_entry__ import SMALL, oracle_sql, queries
from checks.compare import duck, rows_of

LLM = sorted(n for n in queries() if n.startswith("op") or n == "pipeline")


def test_all_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in LLM if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in LLM


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", [n for n in LLM if n in oracle_sql()])
def test_same_as_sql(spark, name):
    df = queries()[name](spark, SMALL)
    cursor = duck(SMALL).execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())
