"""The load of the warehouse moves ids as bytes, and its query stores no more than the trips."""

import hashlib

from pyspark.sql import functions as F

from checks import all_queries, operation_queries, tables
from checks.tables import Tables
from tripmart.sinks.writers import gathered

DIGEST = hashlib.sha256(b"one").hexdigest()
TEXTS = [DIGEST, DIGEST, DIGEST.upper(), DIGEST[:-1], "0f", "0F", "", None, "zz", "é0", " 0f", "0f "]


def test_digests_move_as_bytes_and_other_texts_as_they_are(spark):
    rows = [(i, i % 2, text) for i, text in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "id int, k int, t string")
    moved = gathered(df, ("k",), ("t", "k"))
    assert moved.columns == df.columns and moved.schema["t"].dataType == df.schema["t"].dataType
    assert sorted(map(tuple, moved.collect())) == rows
    assert "_t_bytes" in moved._jdf.queryExecution().optimizedPlan().toString()
    assert "_t_bytes" not in gathered(df, ("k",))._jdf.queryExecution().optimizedPlan().toString()
    sent = moved._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")[1]
    kept = spark.createDataFrame([(0, 0, DIGEST)], df.schema)
    fits = F.coalesce(F.lower(F.hex(F.unhex("t"))) == F.col("t"), F.lit(False))
    assert "unhex" in sent and kept.where(fits).count() == 1


MADE = {
    "lineitem": "SELECT 1 AS l_orderkey, 11 AS l_partkey, CAST(id AS BIGINT) AS l_suppkey, 2 AS l_linenumber, "
    "5.0D AS l_quantity, 40.5D AS l_extendedprice, 0.1D AS l_discount, 0.2D AS l_tax, 'N' AS l_returnflag, "
    "'O' AS l_linestatus, DATE'1996-02-03' AS l_shipdate FROM range(21, 26)",
    "orders": "SELECT 1 AS o_orderkey, 31 AS o_custkey, TIMESTAMP_NTZ'1996-02-01 00:00:00' AS o_orderdate",
    "customer": "SELECT 31 AS c_custkey, 7 AS c_nationkey",
    "supplier": "SELECT CAST(id AS BIGINT) AS s_suppkey, 's' AS s_name, 8 AS s_nationkey FROM range(21, 26)",
    "nation": "SELECT CAST(id AS INT) AS n_nationkey, 'n' AS n_name, 1 AS n_regionkey FROM range(7, 9)",
    "region": "SELECT 1 AS r_regionkey, 'r' AS r_name",
}


def test_the_query_stores_trips_without_names_and_ids(spark, tmp_path, monkeypatch):
    for name, made in MADE.items():
        spark.sql(made).write.parquet(f"{tmp_path}/{name}.parquet")
    stored = []
    for module in (tables, operation_queries):

        def kept(df, cut=module.cut):
            stored.append(df.columns)
            return cut(df)

        monkeypatch.setattr(module, "cut", kept)
    found = all_queries()["warehouse_rejects"].run(Tables(spark, str(tmp_path)))
    assert sorted(map(tuple, found.collect())) == [
        (21, "vendor_code too long", 1, 3),
        (22, "fare_amount out of range", 1, 3),
        (23, "trip_id is null", 1, 3),
    ]
    assert stored and not any("trip_id" in columns for columns in stored)
