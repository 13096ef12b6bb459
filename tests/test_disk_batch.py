"""A batch run moves what is small, and keeps no more on the disks than it needs."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from tripmart import runtime, schemas
from tripmart.plans import batch_run, warehouse
from tripmart.sinks.writers import write_zone


def test_dates_of_a_large_batch_are_small(spark, tmp_path, monkeypatch):
    """A join on dates goes by the dates' own size, so that no trip is shuffled for it."""
    at = F.expr("timestamp_ntz'2022-05-01 09:00:00' + make_dt_interval(id % 9, 0, 0, 0)")
    trips = spark.range(30_000).select(at.alias("pickup_datetime"), F.rand(3).alias("fare"))
    write_zone(
        trips.withColumn("batch", F.lit("b-r")), f"{tmp_path}/processed/yellow_taxi", ("batch",)
    )
    monkeypatch.setattr(runtime, "CHECK_BYTES", 50_000)
    assert not runtime.is_small(spark.read.parquet(f"{tmp_path}/processed/yellow_taxi"))
    dates = batch_run.touched_dates(spark, str(tmp_path), "r")
    assert runtime.is_small(dates) and dates.count() == 9


def stored_fact(spark, folder):
    """Two trips a day over three months, by date, in the columns of the warehouse."""
    columns = {c: t for c, (t, _, _) in schemas.WAREHOUSE_FACT.items()}
    made = {
        "trip_id": F.sha2(F.col("id").cast("string"), 256),
        "pickup_date": F.expr("date_add(date'2020-01-10', CAST(id DIV 2 AS INT))"),
        "vendor_id": F.col("id").cast("int"),
    }
    rows = spark.range(120).select(
        *[
            made[c].alias(c) if c in made else F.lit("1").try_cast(t).alias(c)
            for c, t in columns.items()
        ]
    )
    rows = rows.withColumns(
        {
            c: F.col("pickup_date").cast("timestamp_ntz").cast(columns[c])
            for c in ("pickup_datetime", "dropoff_datetime")
        }
    )
    rows.write.partitionBy("pickup_date").parquet(folder)
    return spark.read.parquet(folder)


def test_the_warehouse_takes_a_fact_by_date_without_a_shuffle(spark, tmp_path, monkeypatch):
    fact = stored_fact(spark, f"{tmp_path}/fact")
    dates = spark.createDataFrame([(dt.date(2020, 1, 20),), (dt.date(2020, 2, 3),)], "pickup_date date")
    monkeypatch.setattr(batch_run, "MONTH_ROWS", 40)
    laid = batch_run.by_month(fact, dates)
    assert laid.count() == 2 * (22 + 29)
    assert laid.rdd.getNumPartitions() == 2 + 2  # 44 and 58 rows
    assert "Exchange" not in laid._jdf.queryExecution().executedPlan().toString()
    found = []
    for base, df, by_month in (("a", fact, False), ("b", laid, True)):
        assert warehouse.load({"fact_trip": df}, f"{tmp_path}/{base}", dates, by_month) == {"fact_trip": 0}
        rows = spark.read.parquet(f"{tmp_path}/{base}/warehouse/fact_trip")
        found.append(sorted((r.trip_id, r.pickup_month, r.vendor_id) for r in rows.collect()))
    assert found[0] == found[1] and len(found[0]) == 102
    assert batch_run.by_month(fact, dates.limit(0)) is None
    monkeypatch.setattr(batch_run, "MONTHS_APART", 1)
    assert batch_run.by_month(fact, dates) is None


def shuffle_files(spark):
    disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tops = [str(d) for d in disks.localDirs()]
    return {f for top in tops for _, _, files in os.walk(top) for f in files if f.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(2000).withColumn("k", F.col("id") % 3)
    write_zone(rows, f"{tmp_path}/zone", ("k",))
    runtime.cut(rows.groupBy("k").count())
    for _ in range(40):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    assert not left
    assert spark.read.parquet(f"{tmp_path}/zone").count() == 2000
