"""Warehouse, alarms, the batch run and the streaming forms."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from checks.etl_queries import VALID, fact
from checks.master_queries import (
    T1,
    T2,
    ZONE_ATTRS,
    ZONE_MERGED,
    ZONE_REVISED,
    VENDOR_ATTRS,
    VENDOR_MERGED,
    VENDOR_TABLES,
    ZONE_TABLES,
    vendor_history,
    zone_history,
    zone_load,
)
from checks.quality_queries import ALL_RUNS, RUN_TABLES, stored_results, stored_summary, summary_sql
from checks.registry import dbl, half_up, query, ts
from checks.tables import Tables
from tripmart import schemas
from tripmart.operators import dimensions, facts, key_index, quality, scd2
from tripmart.operators.standardize import standard_trips
from tripmart.plans import monitoring, warehouse, zone_tables
from tripmart.plans.batch_run import run_batch
from tripmart.runtime import cut, fresh_folder
from tripmart.sinks.snapshots import publish_snapshot, read_snapshot
from tripmart.sinks.writers import write_zone
from tripmart.sources.readers import read_trips, register_catalog
from tripmart.streaming.alarms import alarm_transitions_stream, run_alarms
from tripmart.streaming.landing import landing_stream, raw_landing_stream
from tripmart.streaming.scd2 import scd2_stream

# --- warehouse ------------------------------------------------------------------------


def enriched(t: Tables) -> DataFrame:
    return facts.enrich_fact(fact(t), t.zones(), t.vendors())


def wide(t: Tables) -> DataFrame:
    """The enriched fact with values that break limits of the warehouse."""
    bad = F.col("vendor_id") % 10
    return enriched(t).withColumns(
        {
            "vendor_code": F.when(bad == 1, F.repeat(F.lit("x"), 40)).otherwise(F.col("vendor_code")),
            "fare_amount": F.when(bad == 2, F.lit(123456789.5).cast("decimal(12,2)")).otherwise(
                F.col("fare_amount")
            ),
            "trip_id": F.when(bad != 3, F.col("trip_id")),
        }
    )


MEASURES = f"""
    {half_up('fare_amount * 100', 'CAST(trip_distance * 100 AS BIGINT)', 2)} AS fare_per_mile,
    {half_up('tip_amount * 100', 'CAST(fare_amount * 100 AS BIGINT)', 4)} AS tip_pct"""
WAREHOUSE_SQL = f"""trip_id, vendor_id, passenger_count, pu_location_id, do_location_id,
    {dbl('trip_distance')} AS trip_distance, {dbl('fare_amount')} AS fare_amount,
    {dbl('tip_amount')} AS tip_amount, {dbl('total_amount')} AS total_amount,
    {dbl('trip_duration_min')} AS trip_duration_min, {MEASURES}"""
KEPT = (
    "trip_id vendor_id passenger_count pu_location_id do_location_id trip_distance fare_amount "
    "tip_amount total_amount trip_duration_min fare_per_mile tip_pct"
).split()

query("warehouse_types", ("fact",), f"SELECT {WAREHOUSE_SQL} FROM fact")(
    lambda t: warehouse.warehouse_types(enriched(t), schemas.WAREHOUSE_FACT).select(*KEPT)
)
query(
    "load_rejects",
    ("fact",),
    """SELECT vendor_id, CASE vendor_id % 10 WHEN 1 THEN 'vendor_code too long'
         WHEN 2 THEN 'fare_amount out of range' ELSE 'trip_id is null' END AS load_errors,
         count(*) AS trips FROM fact WHERE vendor_id % 10 IN (1, 2, 3) GROUP BY 1, 2""",
)(
    lambda t: warehouse.load_rejects(wide(t), schemas.WAREHOUSE_FACT)
    .withColumn("load_errors", F.array_join("load_errors", ", "))
    .groupBy("vendor_id", "load_errors")
    .agg(F.count(F.lit(1)).alias("trips"))
)
@query(
    "load_layout",
    ("fact",),
    """SELECT pu_location_id, count(*) AS trips, CAST(0 AS BIGINT) AS unsorted
       FROM fact GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    """Rows per zone, and rows that come before an earlier date of their zone and file."""
    place = F.monotonically_increasing_id()
    laid = warehouse.load_layout(fact(t)).select(
        "pu_location_id", "pickup_date", place.alias("place"), F.spark_partition_id().alias("part")
    )
    folder = fresh_folder(t.spark, "layout") + "/fact"
    laid.write.parquet(folder)
    within = Window.partitionBy("part", "pu_location_id").orderBy("place")
    earlier = F.lag("pickup_date").over(within) > F.col("pickup_date")
    return (
        t.spark.read.parquet(folder)
        .withColumn("_earlier", earlier)
        .groupBy("pu_location_id")
        .agg(F.count(F.lit(1)).alias("trips"), F.count_if("_earlier").alias("unsorted"))
    )


@query(
    "fact_by_zone",
    ("fact", "zones"),
    """SELECT z.borough, count(*) AS trips, CAST(sum(f.fare_amount) AS DOUBLE) AS fares,
         count(DISTINCT f.pickup_date) AS days
       FROM fact f LEFT JOIN zones z ON z.location_id = f.pu_location_id GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    """Fares by borough from the bucketed tables; the join moves no trip."""
    base, mark = fresh_folder(t.spark, "by-zone"), uuid.uuid4().hex
    names = [f"fact_{mark}", f"zones_{mark}"]
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    trips = fact(t).select("pu_location_id", "pickup_date", "fare_amount")
    zone_tables.save_fact_by_zone(trips, names[0], f"{base}/fact", buckets)
    zones = t.zones().select("location_id", "borough")
    zone_tables.save_zone_slices(zones, "location_id", names[1], f"{base}/zones", buckets)
    joined = zone_tables.fact_with_zones(t.spark, *names)
    joined.schema  # resolved while the names are known
    for name in names:  # the files stay
        t.spark.sql(f"DROP TABLE {name}")
    return joined.groupBy("borough").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("fare_amount").alias("fares"),
        F.count_distinct("pickup_date").alias("days"),
    )


def warehouse_tables(t: Tables, trips: DataFrame) -> dict[str, DataFrame]:
    calendar = dimensions.dim_date_numbered(trips)
    return {
        "fact_trip": trips,
        "dim_date": calendar.withColumnRenamed("day_of_week_name", "day_of_week"),
        "dim_zone_scd2": scd2.with_surrogate_keys(zone_history(t), ZONE_ATTRS),
        "dim_vendor_scd2": scd2.with_surrogate_keys(vendor_history(t), VENDOR_ATTRS),
        "dq_run_summary": stored_summary(t),
    }


OTHER_TABLES = f"""
    UNION ALL SELECT 'dim_date', count(DISTINCT pickup_date) FROM fact
    UNION ALL SELECT 'dim_zone_scd2', count(*) FROM {ZONE_MERGED}
    UNION ALL SELECT 'dim_vendor_scd2', count(*) FROM {VENDOR_MERGED}
    UNION ALL SELECT 'dq_run_summary', 3"""
HISTORY_TABLES = (*ZONE_TABLES, *VENDOR_TABLES)


@query(
    "warehouse_load",
    ("fact", *HISTORY_TABLES),
    f"""SELECT 'fact_trip' AS tbl, count(*) AS rows FROM fact
        WHERE vendor_id % 10 NOT IN (1, 2, 3) {OTHER_TABLES}""",
)
def _(t: Tables) -> DataFrame:
    """Rows per warehouse table after a load; rejected rows are not in it."""
    base = fresh_folder(t.spark, "warehouse")
    t.park_trips()
    tables = warehouse_tables(t, cut(wide(t)))
    warehouse.load(tables, base)
    return warehouse.load_counts(
        {name: t.spark.read.parquet(f"{base}/warehouse/{name}") for name in tables}
    )


@query(
    "warehouse_rejects",
    ("fact",),
    """SELECT vendor_id, CASE vendor_id % 10 WHEN 1 THEN 'vendor_code too long'
         WHEN 2 THEN 'fare_amount out of range' ELSE 'trip_id is null' END AS load_errors,
         count(*) AS trips, sum(count(*)) OVER () AS reported
       FROM fact WHERE vendor_id % 10 IN (1, 2, 3) GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    """What a load keeps of the rows that it refuses, and the number it reports."""
    base = fresh_folder(t.spark, "rejects")
    # The load reads its frame twice: of the stored trips, names and ids are added again.
    t.park_trips()
    reported = warehouse.load({"fact_trip": wide(t)}, base)["fact_trip"]
    return (
        t.spark.read.parquet(f"{base}/warehouse/_rejects/fact_trip")
        .groupBy("vendor_id", F.array_join("load_errors", ", ").alias("load_errors"))
        .agg(F.count(F.lit(1)).alias("trips"), F.lit(reported).cast("bigint").alias("reported"))
    )


@query(
    "load_counts",
    ("fact", *HISTORY_TABLES),
    f"SELECT 'fact_trip' AS tbl, count(*) AS rows FROM fact {OTHER_TABLES}",
)
def _(t: Tables) -> DataFrame:
    return warehouse.load_counts(warehouse_tables(t, fact(t)))


@query(
    "catalog_tables",
    ("fact", "zones", "vendors", *RUN_TABLES, *HISTORY_TABLES),
    f"""SELECT 'fact_trip' AS tbl, count(*) AS rows, {dbl("sum(fare_amount)")} AS total FROM fact
        UNION ALL SELECT 'dim_date', count(DISTINCT pickup_date),
          sum(DISTINCT CAST(strftime(pickup_date, '%Y%m%d') AS DOUBLE)) FROM fact
        UNION ALL SELECT 'dim_zone', count(*), {dbl("sum(location_id)")} FROM zones
        UNION ALL SELECT 'dim_vendor', count(*), {dbl("sum(vendor_id)")} FROM vendors
        UNION ALL SELECT 'dq_results', count(*), {dbl("sum(failed_rows)")} FROM ({ALL_RUNS})
        UNION ALL SELECT 'dq_run_summary', count(*), {dbl("sum(total_rows)")}
          FROM ({summary_sql(ALL_RUNS)})
        UNION ALL SELECT 'dim_zone_scd2', count(*), {dbl("sum(natural_key)")} FROM {ZONE_MERGED}
        UNION ALL SELECT 'dim_vendor_scd2', count(*), {dbl("sum(natural_key)")} FROM {VENDOR_MERGED}""",
)
def _(t: Tables) -> DataFrame:
    """Rows and a sum of every table and snapshot that the catalog finds."""
    base = fresh_folder(t.spark, "catalog")
    t.park_trips()
    stored = f"{base}/{schemas.CATALOG['fact_trip'][0]}"
    fact(t).write.option("compression", "zstd").parquet(stored)
    trips = t.spark.read.parquet(stored)
    results = cut(stored_results(t))
    made = {
        "dim_date": dimensions.dim_date(trips),
        "dim_zone": dimensions.dim_zone(t.zones()),
        "dim_vendor": dimensions.dim_vendor(t.vendors()),
        "dq_results": results,
        "dq_run_summary": quality.dq_run_summary(results),
    }
    for name, rows in made.items():
        rows.write.parquet(f"{base}/{schemas.CATALOG[name][0]}")
    publish_snapshot(zone_history(t), f"{base}/{schemas.SNAPSHOTS['dim_zone_scd2']}")
    publish_snapshot(vendor_history(t), f"{base}/{schemas.SNAPSHOTS['dim_vendor_scd2']}")
    sums = {
        "fact_trip": "fare_amount",
        "dim_date": "date_key",
        "dim_zone": "location_id",
        "dim_vendor": "vendor_id",
        "dq_results": "failed_rows",
        "dq_run_summary": "total_rows",
        "dim_zone_scd2": "natural_key",
        "dim_vendor_scd2": "natural_key",
    }
    found = register_catalog(t.spark, base, "all_")
    counted = [
        t.spark.table(name).agg(
            F.lit(name.removeprefix("all_")).alias("tbl"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(sums[name.removeprefix("all_")]).cast("double").alias("total"),
        )
        for name in found
    ]
    return reduce(DataFrame.unionByName, counted)


# --- monitoring -----------------------------------------------------------------------

ALARM_VALUES = ", ".join(
    f"('{n}', '{ns}', '{m}', '{s}', '{c}', {dbl(str(th))})" for n, ns, m, s, c, th in schemas.ALARMS
)
STATISTICS = f"""
    a AS (SELECT * FROM (VALUES {ALARM_VALUES})
          AS v(name, namespace, metric, statistic, comparison, threshold)),
    p AS (SELECT namespace, metric, time_bucket(INTERVAL 300 SECONDS, ts) AS period_start,
                 CAST(sum(value) AS DOUBLE) AS s, CAST(min(value) AS DOUBLE) AS lo,
                 CAST(max(value) AS DOUBLE) AS hi FROM metrics GROUP BY ALL),
    j AS (SELECT name, namespace, metric, period_start, threshold, statistic, comparison,
                 CASE statistic WHEN 'Sum' THEN s WHEN 'Minimum' THEN lo ELSE hi END AS value
          FROM p JOIN a USING (namespace, metric)),
    k AS (SELECT *, CASE comparison WHEN '>=' THEN value >= threshold
                         WHEN '>' THEN value > threshold ELSE value < threshold END AS breach
          FROM j),
    periods AS (SELECT name, namespace, metric, period_start, value, threshold,
                 CASE WHEN breach THEN 'ALARM' ELSE 'OK' END AS state,
                 statistic || CASE WHEN breach THEN ' breaches ' ELSE ' does not breach ' END
                   || comparison || ' ' || CAST(threshold AS DECIMAL(18,2)) AS reason FROM k)"""
PERIOD_SQL = f"* REPLACE ({ts('period_start')} AS period_start)"

query("metric_alarms", ("metrics",), f"WITH {STATISTICS} SELECT {PERIOD_SQL} FROM periods")(
    lambda t: monitoring.metric_alarms(t.metrics())
)
query(
    "alarm_status",
    ("metrics",),
    f"""WITH {STATISTICS}
        SELECT a.name, a.namespace, a.metric, a.threshold, coalesce(l.state, 'OK') AS state,
          coalesce(l.reason, 'no data, treated as not breaching') AS reason,
          {ts('l.period_start')} AS updated_at
        FROM a LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY name ORDER BY period_start DESC)
                            AS rn FROM periods) l ON l.name = a.name AND l.rn = 1""",
)(lambda t: monitoring.alarm_status(t.metrics()))


@query(
    "alert_rows",
    RUN_TABLES,
    f"""WITH s AS ({summary_sql(ALL_RUNS)}),
          w AS (SELECT *, CASE WHEN status = 'PASS' THEN 'SUCCEEDED' ELSE 'FAILED' END AS word FROM s)
        SELECT run_id, 'tripmart ' || word AS subject, concat_ws(chr(10),
          CASE WHEN status = 'PASS' THEN '[OK]' ELSE '[ALERT]' END || ' tripmart pipeline: ' || word,
          'project: tripmart', 'run_id: ' || run_id,
          'quality_score: ' || CAST(quality_score AS DECIMAL(5,4)), 'rejected_rows: ' || rejected_rows,
          CASE WHEN status <> 'PASS' THEN 'error: quality gate failed' END,
          '-- tripmart alerts v1.0') AS message FROM w""",
)
def _(t: Tables) -> DataFrame:
    failed = F.col("status") != "PASS"
    return monitoring.alert_rows(
        stored_summary(t)
        .withColumn("error", F.when(failed, "quality gate failed"))
        .withColumn("status", F.when(failed, "FAILED").otherwise("SUCCEEDED"))
    )


# --- batch run ------------------------------------------------------------------------


def landing_zone(t: Tables, trips: DataFrame) -> str:
    """An incoming zone with parquet trips and csv masters."""
    base = fresh_folder(t.spark, "lake")
    trips.drop("l_orderkey").write.option("compression", "zstd").parquet(
        f"{base}/incoming/yellow_taxi/day1"
    )
    t.zones().toDF("LocationID", "Borough", "Zone", "service_zone").write.option("header", True).csv(
        f"{base}/incoming/taxi_zones/day1"
    )
    t.vendors().select(
        "*",
        F.lit("ops@x.org").alias("contact_email"),
        F.lit("tlc_registry").alias("source_system"),
        F.lit("2024-01-02").cast("date").alias("updated_at"),
    ).write.option("header", True).csv(f"{base}/incoming/vendors/day1")
    return base


@query(
    "batch_run",
    ("landed",),
    """SELECT 'r1' AS run_id, step, status, rows FROM (VALUES
          ('land', 'done', (SELECT count(*) FROM landed) + (SELECT count(*) FROM nation)
             + (SELECT count(*) FROM supplier)),
          ('etl', 'done', (SELECT count(*) FROM landed)),
          ('quality', 'done', 0), ('gate', 'done', 0),
          ('transform', 'done', (SELECT count(*) FROM landed)),
          ('history', 'done', (SELECT count(*) FROM nation) + (SELECT count(*) FROM supplier)),
          ('rejects', 'done', 0),
          ('warehouse', 'done', (SELECT count(*) + count(DISTINCT CAST(pickup_datetime AS DATE)) + 1
             + (SELECT count(*) FROM nation) + (SELECT count(*) FROM supplier) FROM landed))
        ) AS v(step, status, rows)""",
)
def _(t: Tables) -> DataFrame:
    """A clean feed goes through all steps."""
    base = landing_zone(t, t.trips_landed())
    return run_batch(t.spark, base, "r1", "2024-03-01 00:00:00").to_df(t.spark)


@query(
    "batch_run_stopped",
    ("dirty",),
    f"""SELECT 'r1' AS run_id, step, status, rows FROM (VALUES
          ('land', 'done', (SELECT count(*) FROM dirty) + (SELECT count(*) FROM nation)
             + (SELECT count(*) FROM supplier)),
          ('etl', 'done', (SELECT count(*) FROM dirty WHERE {VALID})),
          ('quality', 'done', (SELECT count(*) FROM dirty WHERE NOT {VALID})),
          ('gate', 'failed', 4), ('transform', 'skipped', 0), ('history', 'skipped', 0),
          ('warehouse', 'skipped', 0), ('rejects', 'skipped', 0)) AS v(step, status, rows)""",
)
def _(t: Tables) -> DataFrame:
    """A dirty feed is stopped by the quality gate."""
    base = landing_zone(t, t.dirty_landed())
    return run_batch(t.spark, base, "r1", "2024-03-01 00:00:00").to_df(t.spark)


@query(
    "batch_run_twice",
    ("fact",),
    f"""SELECT 'fact_trip' AS tbl, trip_id AS id, {dbl('fare_amount')} AS value FROM fact
        UNION ALL SELECT 'warehouse fact_trip', trip_id, {dbl('fare_amount')} FROM fact
        UNION ALL SELECT DISTINCT 'dim_date', strftime(pickup_date, '%Y-%m-%d'),
          CAST(year(pickup_date) AS DOUBLE) FROM fact
        UNION ALL SELECT 'dim_zone_scd2', CAST(n_nationkey AS VARCHAR), 1.0 FROM nation
        UNION ALL SELECT 'dim_vendor_scd2', CAST(s_suppkey AS VARCHAR), 1.0 FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    """The tables after two batches that share dates, the second of them run again."""
    trips = t.trips_landed()
    odd = F.col("l_orderkey") % 2 == 1
    base = landing_zone(t, trips.filter(odd))
    run_batch(t.spark, base, "1", "2024-03-01 00:00:00")
    trips.filter(~odd).drop("l_orderkey").write.option("compression", "zstd").parquet(
        f"{base}/incoming/yellow_taxi/day2"
    )
    for _ in range(2):
        run_batch(t.spark, base, "2", "2024-03-02 00:00:00")

    def rows(name: str, df: DataFrame, key, value) -> DataFrame:
        return df.select(
            F.lit(name).alias("tbl"), key.cast("string").alias("id"), value.cast("double").alias("value")
        )

    read = t.spark.read.parquet
    facts_of = [
        rows(name, read(f"{base}/{folder}/fact_trip"), F.col("trip_id"), F.col("fare_amount"))
        for name, folder in (("fact_trip", "curated"), ("warehouse fact_trip", "warehouse"))
    ]
    calendar = rows(
        "dim_date", read(f"{base}/curated/dim_date"), F.col("pickup_date"), F.col("year")
    )
    histories = [
        rows(
            name,
            read_snapshot(t.spark, f"{base}/master/{name}").groupBy("natural_key").count(),
            F.col("natural_key"),
            F.col("count"),
        )
        for name in ("dim_zone_scd2", "dim_vendor_scd2")
    ]
    return reduce(DataFrame.unionByName, [*facts_of, calendar, *histories])


@query(
    "repeats_across_batches",
    ("landed",),
    """WITH brought AS (
          SELECT l.*, b.batch FROM landed AS l, (VALUES ('b-1'), ('b-2'), ('b-3')) AS b(batch)
          WHERE CASE b.batch WHEN 'b-1' THEN l_orderkey % 2 = 1 WHEN 'b-2' THEN l_orderkey % 2 = 0
              OR l_orderkey % 5 = 1 ELSE l_orderkey % 6 < 2 END),
        grouped AS (SELECT batch, vendor_id, pickup_datetime, dropoff_datetime, pu_location_id,
            do_location_id, count(*) AS n FROM brought GROUP BY ALL),
        keyed AS (SELECT batch, n, count(*) OVER k AS batches, min(batch) OVER k AS first
          FROM grouped WINDOW k AS (PARTITION BY vendor_id, pickup_datetime, dropoff_datetime,
            pu_location_id, do_location_id))
        SELECT batch, CAST(sum(n - 1 + CASE WHEN batches > 1 THEN 1 ELSE 0 END) AS BIGINT)
            AS duplicate_rows,
          CAST(sum(CASE WHEN batch = first THEN n ELSE 0 END) AS BIGINT) AS fact_rows
        FROM keyed GROUP BY batch""",
)
def _(t: Tables) -> DataFrame:
    """What the duplicate rule counts in each of three batches, and what the fact takes."""
    base = fresh_folder(t.spark, "repeats")
    key = F.col("l_orderkey")
    chosen = {"b-1": key % 2 == 1, "b-2": (key % 2 == 0) | (key % 5 == 1), "b-3": key % 6 < 2}
    landed = t.trips_landed()
    for batch, some in chosen.items():
        trips = standard_trips(landed.filter(some)).withColumn("batch", F.lit(batch))
        write_zone(trips, f"{base}/trips", ("batch",), only_touched=True, gather=False)
        key_index.index_batch(t.spark.read.parquet(f"{base}/trips").where(F.col("batch") == batch), base)
    trips = t.spark.read.parquet(f"{base}/trips")
    index = key_index.read_index(t.spark, base)
    shared = key_index.shared_keys(index, index.select("pickup_month"))
    copies = shared.where("batch <> first").select("digest", "batch")
    taken = key_index.without_later_copies(trips, copies)
    counted = [
        quality.rule_counts(
            trips.where(F.col("batch") == batch),
            None,
            None,
            keys=key_index.batch_keys(index, shared, batch),
        ).select(F.lit(batch).alias("batch"), F.col("R08").alias("duplicate_rows"))
        for batch in chosen
    ]
    rows = taken.groupBy("batch").agg(F.count(F.lit(1)).alias("fact_rows"))
    return (
        reduce(DataFrame.unionByName, counted)
        .join(rows, "batch", "left")
        .withColumn("fact_rows", F.coalesce("fact_rows", F.lit(0)))
    )


# --- streaming ------------------------------------------------------------------------


@query(
    "raw_landing_stream",
    ("landed",),
    f"""SELECT vendor_id, {ts('pickup_datetime')} AS pickup_datetime, pu_location_id,
          do_location_id, {dbl('fare_amount')} AS fare_amount FROM landed""",
)
def _(t: Tables) -> DataFrame:
    """Two deliveries; the second run of the stream lands only the new files."""
    base = fresh_folder(t.spark, "stream")
    trips = t.trips_landed()
    half = F.col("l_orderkey") % 2 == 0
    for part in (trips.filter(half), trips.filter(~half)):
        part.drop("l_orderkey").write.mode("append").parquet(f"{base}/incoming/trips")
        raw_landing_stream(
            t.spark,
            f"{base}/incoming/trips",
            f"{base}/raw/trips",
            f"{base}/checkpoints/landing",
            trips.drop("l_orderkey").schema,
        ).awaitTermination()
    return standard_trips(t.spark.read.parquet(f"{base}/raw/trips")).select(
        "vendor_id", "pickup_datetime", "pu_location_id", "do_location_id", "fare_amount"
    )


@query(
    "landing_stream_kinds",
    ("landed",),
    f"""SELECT vendor_id, {ts('pickup_datetime')} AS pickup_datetime, pu_location_id,
          do_location_id, {dbl('fare_amount')} AS fare_amount, kind
        FROM (SELECT *, CASE l_orderkey % 4 WHEN 0 THEN 'parquet' WHEN 3 THEN 'json' ELSE 'csv' END
          AS kind FROM landed)""",
)
def _(t: Tables) -> DataFrame:
    """Four deliveries: parquet, csv, csv with its columns turned round, json."""
    base = fresh_folder(t.spark, "stream")
    trips = t.trips_landed()
    names = [c for c in trips.columns if c != "l_orderkey"]
    for part, kind in enumerate(("parquet", "csv", "csv", "json")):
        rows = trips.filter(F.pmod("l_orderkey", F.lit(4)) == part)
        rows = rows.select(*(reversed(names) if part == 2 else names))
        rows.write.option("header", True).format(kind).save(f"{base}/incoming/trips/{part}")
        landing_stream(t.spark, base, f"{base}/checkpoint", 3).awaitTermination()
    landed = read_trips(t.spark, f"{base}/raw/trips")
    kind = F.substring_index("_landed_from", ".", -1)
    return standard_trips(landed.withColumn("kind", kind).drop("_landed_from")).select(
        "vendor_id", "pickup_datetime", "pu_location_id", "do_location_id", "fare_amount", "kind"
    )


def transitions_sql(end: str) -> str:
    """Changes over every period from an alarm's first to ``end``, with those without data."""
    return f"""WITH {STATISTICS}, span AS (
          SELECT name, unnest(generate_series(min(period_start), {end}, INTERVAL 300 SECONDS))
            AS period_start FROM periods GROUP BY name),
        every AS (SELECT name, s.period_start, coalesce(p.state, 'OK') AS state,
            coalesce(p.reason, 'no data, treated as not breaching') AS reason
          FROM span s LEFT JOIN periods p USING (name, period_start)),
        told AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY name ORDER BY period_start), 'OK')
            AS was FROM every)
        SELECT name, {ts('period_start')} AS period_start, state, reason FROM told WHERE state <> was"""


query("alarm_transitions", ("metrics",), transitions_sql("(SELECT max(ts) FROM metrics)"))(
    lambda t: monitoring.alarm_transitions(t.metrics())
)


@query(
    "alarm_transitions_stream",
    ("metrics",),
    transitions_sql("(SELECT max(ts) FROM metrics) - INTERVAL 10 MINUTES - INTERVAL 300 SECONDS"),
)
def _(t: Tables) -> DataFrame:
    """The metrics in three deliveries by time; the checkpoint carries the alarms over."""
    base = fresh_folder(t.spark, "changes-of-alarms")
    metrics = t.metrics()
    ends = metrics.select(F.unix_seconds(F.col("ts").cast("timestamp")).alias("s")).agg(
        F.min("s").alias("a"), F.max("s").alias("b")
    )
    third = F.floor(
        (F.unix_seconds(F.col("ts").cast("timestamp")) - F.col("a")) * 3 / (F.col("b") - F.col("a") + 1)
    )
    dealt = metrics.crossJoin(F.broadcast(ends)).withColumn("part", third).drop("a", "b")  # one row
    for part in range(3):
        dealt.filter(F.col("part") == part).drop("part").write.mode("append").parquet(f"{base}/metrics")
        stream = t.spark.readStream.schema(metrics.schema).parquet(f"{base}/metrics")
        run_alarms(
            stream, f"{base}/out", f"{base}/checkpoint", stream=alarm_transitions_stream
        ).awaitTermination()
    return t.spark.read.parquet(f"{base}/out")


@query(
    "metric_alarms_stream",
    ("metrics",),
    f"""WITH {STATISTICS} SELECT {PERIOD_SQL} FROM periods
        WHERE period_start + INTERVAL 300 SECONDS
              <= (SELECT max(ts) FROM metrics) - INTERVAL 10 MINUTES""",
)
def _(t: Tables) -> DataFrame:
    """Periods closed by the watermark; the newest ones are still open."""
    base = fresh_folder(t.spark, "alarms")
    t.metrics().write.parquet(f"{base}/metrics")
    stream = t.spark.readStream.schema(t.metrics().schema).parquet(f"{base}/metrics")
    run_alarms(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{base}/out")


@query("scd2_stream", ZONE_TABLES, f"SELECT * FROM {ZONE_REVISED}")
def _(t: Tables) -> DataFrame:
    """Two deliveries of records, each versioned as one micro-batch."""
    base = fresh_folder(t.spark, "changes")
    dest = f"{base}/dim_zone_scd2"
    publish_snapshot(zone_load(t), dest, partition_by=("is_current",))
    for snapshot in (1, 0):
        t.master_zones(snapshot).write.mode("append").parquet(f"{base}/incoming")
        changes = t.spark.readStream.schema(t.master_zones(0).schema).parquet(f"{base}/incoming")
        scd2_stream(
            changes,
            dest,
            f"{base}/checkpoint",
            "location_id",
            ZONE_ATTRS,
            lambda batch: (T1, T2)[batch],
            [F.col("zone_name"), F.col("borough")],
        ).awaitTermination()
    return read_snapshot(t.spark, dest)
