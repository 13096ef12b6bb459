"""Data-quality rules, scores and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.etl_queries import VALID, clean, dirty, dirty_with_id
from checks.registry import dbl, query, ts
from checks.tables import Tables
from tripmart.operators import quality
from tripmart.operators.standardize import split_valid
from tripmart.runtime import fresh_folder
from tripmart.sinks.writers import append_rows

KEY = "vendor_id, pickup_datetime, dropoff_datetime, pu_location_id, do_location_id"
KEY_SQL = f"""vendor_id, {ts('pickup_datetime')} AS pickup_datetime,
    {ts('dropoff_datetime')} AS dropoff_datetime, pu_location_id, do_location_id"""
RULES = {
    "R01": """vendor_id IS NULL OR pickup_datetime IS NULL OR dropoff_datetime IS NULL
              OR pu_location_id IS NULL OR do_location_id IS NULL OR fare_amount IS NULL""",
    "R02": "dropoff_datetime <= pickup_datetime",
    "R03": "fare_amount < 0",
    "R04": "coalesce(passenger_count, 0) < 0",
    "R05": "vendor_id IS NOT NULL AND vendor_id NOT IN (SELECT vendor_id FROM vendors)",
    "R06": "pu_location_id NOT IN (SELECT location_id FROM zones)",
    "R07": "do_location_id NOT IN (SELECT location_id FROM zones)",
}
TEXTS = {
    "R01": "required columns not null",
    "R02": "pickup before dropoff",
    "R03": "fare_amount >= 0",
    "R04": "passenger_count >= 0",
    "R05": "vendor_id in master",
    "R06": "pickup_location_id in master",
    "R07": "dropoff_location_id in master",
    "R08": "duplicate trip detection",
    "R09": "row count >= 1",
}
MASTERS = ("zones", "vendors")


def counts_sql(table: str) -> str:
    """(rule_id, failed_rows) of all nine rules, from one scan and one grouping."""
    flags = ", ".join(
        f"count(*) FILTER ({cond}) AS {rule}" for rule, cond in RULES.items()
    )
    rules = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule_id, {rule} AS failed_rows, total FROM c" for rule in RULES
    )
    return f"""
      (WITH c AS (SELECT count(*) AS total, {flags} FROM {table})
       {rules}
       UNION ALL SELECT 'R08', (SELECT coalesce(CAST(sum(n - 1) AS BIGINT), 0) FROM (
           SELECT count(*) AS n FROM {table} GROUP BY {KEY})), total FROM c
       UNION ALL SELECT 'R09', CASE WHEN total >= 1 THEN 0 ELSE 1 END, total FROM c)"""


def results_sql(table: str, run_id: str, run_ts: str) -> str:
    texts = " ".join(f"WHEN '{rule}' THEN '{text}'" for rule, text in TEXTS.items())
    return f"""
      SELECT rule_id, CASE rule_id {texts} END AS description, failed_rows,
             CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
             '{run_id}' AS run_id, '{run_ts}' AS run_ts,
             round(count(*) FILTER (failed_rows = 0) OVER () / 9.0, 4) AS quality_score,
             total AS total_rows
      FROM {counts_sql(table)}"""


def summary_sql(results: str) -> str:
    return f"""
      SELECT run_id, run_ts, quality_score, total_rows,
             CAST(sum(failed_rows) AS BIGINT) AS rejected_rows,
             count(*) FILTER (status = 'FAIL') AS failed_rule_count,
             CASE WHEN any_value(quality_score) >= 0.95 THEN 'PASS' ELSE 'FAIL' END AS status
      FROM ({results}) GROUP BY run_id, run_ts, quality_score, total_rows"""


RUN = ("20240101T000000", "2024-01-01T00:00:00")
DIRTY_RUN = results_sql("dirty", *RUN)
# Three runs: all landed rows, the valid ones among them, the clean feed.
ALL_RUNS = " UNION ALL ".join(
    [
        DIRTY_RUN,
        results_sql(f"(SELECT * FROM dirty WHERE {VALID})", "20240102T000000", "2024-01-02T00:00:00"),
        results_sql("landed", "20240103T000000", "2024-01-03T00:00:00"),
    ]
)
RUN_TABLES = ("dirty", "landed", *MASTERS)


def dirty_results(t: Tables) -> DataFrame:
    return quality.dq_results(dirty(t), t.zones(), t.vendors(), *RUN)


def stored_results(t: Tables) -> DataFrame:
    """The results of three runs, appended one after the other."""
    dest = fresh_folder(t.spark, "dq") + "/results"
    t.park_trips()
    runs = {
        RUN: dirty(t),
        ("20240102T000000", "2024-01-02T00:00:00"): split_valid(dirty(t))[0],
        ("20240103T000000", "2024-01-03T00:00:00"): clean(t),
    }
    for run, trips in runs.items():
        append_rows(quality.dq_results(trips, t.zones(), t.vendors(), *run), dest)
    return t.spark.read.parquet(dest)


def stored_summary(t: Tables) -> DataFrame:
    return quality.dq_run_summary(stored_results(t))


# --- listings ---------------------------------------------------------------------

query(
    "dq_required",
    ("dirty_id",),
    f"""SELECT 'R01_required_fields' AS rule_id, trip_id,
          'null required column' AS failure_reason FROM dirty_id WHERE {RULES['R01']}""",
)(lambda t: quality.required_violations(dirty_with_id(t)))
query(
    "dq_datetime",
    ("dirty_id",),
    f"""SELECT 'R02_datetime_validity' AS rule_id, trip_id,
          {ts('pickup_datetime')} AS pickup_datetime, {ts('dropoff_datetime')} AS dropoff_datetime,
          'dropoff not after pickup' AS failure_reason FROM dirty_id WHERE {RULES['R02']}""",
)(lambda t: quality.datetime_violations(dirty_with_id(t)))
query(
    "dq_fare",
    ("dirty_id",),
    f"""SELECT 'R03_fare_validity' AS rule_id, trip_id, {dbl('fare_amount')} AS fare_amount,
          passenger_count, CASE WHEN fare_amount < 0 THEN 'negative fare'
            ELSE 'negative passenger_count' END AS failure_reason
        FROM dirty_id WHERE fare_amount < 0 OR passenger_count < 0""",
)(lambda t: quality.fare_violations(dirty_with_id(t)))
query(
    "dq_passengers",
    ("dirty_id",),
    """SELECT 'R04_passenger_count' AS rule_id, trip_id, passenger_count,
         'negative passenger_count' AS failure_reason FROM dirty_id WHERE passenger_count < 0""",
)(lambda t: quality.passenger_violations(dirty_with_id(t)))

query(
    "dq_vendor_ri",
    ("dirty", *MASTERS),
    f"SELECT 'R05' AS rule_id, count(*) AS failed_rows FROM dirty WHERE {RULES['R05']}",
)(
    lambda t: quality.rule_counts(dirty(t), t.zones(), t.vendors()).select(
        F.lit("R05").alias("rule_id"), F.col("R05").alias("failed_rows")
    )
)
query(
    "dq_zone_ri",
    ("dirty", *MASTERS),
    f"""SELECT 'R06' AS rule_id, count(*) AS failed_rows FROM dirty WHERE {RULES['R06']}
        UNION ALL SELECT 'R07', count(*) FROM dirty WHERE {RULES['R07']}""",
)(
    lambda t: quality.rule_counts(dirty(t), t.zones(), t.vendors())
    .select("R06", "R07")
    .unpivot([], ["R06", "R07"], "rule_id", "failed_rows")
)
query(
    "dq_duplicates",
    ("dirty",),
    f"""SELECT 'R05_duplicate_detection' AS rule_id, {KEY_SQL}, occurrences,
          'duplicate natural key' AS failure_reason
        FROM (SELECT {KEY}, count(*) AS occurrences FROM dirty GROUP BY {KEY})
        WHERE occurrences > 1""",
)(lambda t: quality.duplicate_violations(dirty(t)))
query(
    "duplicate_groups",
    ("dirty",),
    f"""SELECT count(*) AS duplicate_groups FROM (
          SELECT 1 FROM dirty GROUP BY {KEY} HAVING count(*) > 1)""",
)(lambda t: quality.duplicate_groups(dirty(t)))
query(
    "duplicate_excess",
    ("dirty",),
    f"""SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (
          SELECT count(*) AS n FROM dirty GROUP BY {KEY} HAVING count(*) > 1)""",
)(lambda t: quality.duplicate_excess(dirty(t)))
query(
    "dq_row_count",
    ("dirty",),
    """SELECT CASE WHEN count(*) >= 1 THEN 'PASS' ELSE 'FAIL' END AS row_count_check,
         count(*) AS total_rows FROM dirty""",
)(lambda t: quality.row_count_check(dirty(t)))
query(
    "null_profile",
    ("dirty",),
    """SELECT count(*) FILTER (vendor_id IS NULL) AS null_vendor_id,
         count(*) FILTER (pickup_datetime IS NULL) AS null_pickup,
         count(*) FILTER (dropoff_datetime IS NULL) AS null_dropoff,
         count(*) FILTER (fare_amount IS NULL) AS null_fare,
         count(*) FILTER (passenger_count IS NULL) AS null_passengers FROM dirty""",
)(lambda t: quality.null_profile(dirty(t)))

for _name, _key, _master, _master_key in (
    ("anti_vendor", "vendor_id", "vendors", "vendor_id"),
    ("anti_pickup", "pu_location_id", "zones", "location_id"),
    ("anti_dropoff", "do_location_id", "zones", "location_id"),
):
    query(
        _name,
        ("dirty_id", _master),
        f"""SELECT trip_id, {_key} FROM dirty_id d
            WHERE NOT EXISTS (SELECT 1 FROM {_master} m WHERE m.{_master_key} = d.{_key})""",
    )(
        lambda t, k=_key, m=_master, mk=_master_key: quality.missing_in_master(
            dirty_with_id(t), k, getattr(t, m)(), mk
        ).select("trip_id", k)
    )

INTEGRITY = " UNION ALL ".join(
    f"""SELECT 'R04_referential_integrity' AS rule_id, trip_id, '{text}' AS failure_reason
        FROM dirty_id d WHERE NOT EXISTS (SELECT 1 FROM {m} m WHERE m.{mk} = d.{k})"""
    for k, m, mk, text in (
        ("vendor_id", "vendors", "vendor_id", "vendor_id not in master"),
        ("pu_location_id", "zones", "location_id", "pickup_location_id not in master"),
        ("do_location_id", "zones", "location_id", "dropoff_location_id not in master"),
    )
)
query("ri_violations", ("dirty_id", *MASTERS), INTEGRITY)(
    lambda t: quality.integrity_violations(dirty_with_id(t), t.zones(), t.vendors())
)
query("ri_violations_union", ("dirty_id", *MASTERS), INTEGRITY)(
    lambda t: quality.union_integrity_violations(dirty_with_id(t), t.zones(), t.vendors())
)
query(
    "membership",
    ("dirty", *MASTERS),
    """SELECT count(*) FILTER (vendor_id NOT IN (SELECT vendor_id FROM vendors)) AS unknown_vendor,
         count(*) FILTER (pu_location_id NOT IN (SELECT location_id FROM zones)) AS unknown_pickup,
         count(*) FILTER (do_location_id NOT IN (SELECT location_id FROM zones)) AS unknown_dropoff
       FROM dirty""",
)(
    lambda t: quality.rule_counts(dirty(t), t.zones(), t.vendors()).select(
        F.col("R05").alias("unknown_vendor"),
        F.col("R06").alias("unknown_pickup"),
        F.col("R07").alias("unknown_dropoff"),
    )
)
VIOLATIONS = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule_id, {KEY_SQL}, 1 AS failed_rows FROM dirty WHERE {cond}"
    for rule, cond in RULES.items()
)
query(
    "dq_violations",
    ("dirty", *MASTERS),
    f"""{VIOLATIONS} UNION ALL
        SELECT 'R08', {KEY_SQL}, n - 1 FROM (
          SELECT {KEY}, count(*) AS n FROM dirty GROUP BY {KEY} HAVING count(*) > 1)""",
)(lambda t: quality.dq_violations(dirty(t), t.zones(), t.vendors()))
query(
    "dq_route",
    ("dirty", *MASTERS),
    f"""SELECT route, count(*) AS trips, {dbl('sum(fare_amount)')} AS fares,
          CAST(sum(passenger_count) AS BIGINT) AS passengers FROM (
          SELECT fare_amount, abs(passenger_count) AS p0,
            CASE WHEN passenger_count < 0 THEN 1 ELSE passenger_count END AS passenger_count,
            CASE WHEN ({RULES['R01']}) OR ({RULES['R03']}) THEN 'reject'
                 WHEN {RULES['R02']} THEN 'quarantine'
                 WHEN ({RULES['R05']}) OR ({RULES['R06']}) OR ({RULES['R07']}) THEN 'warn'
                 ELSE 'accept' END AS route
          FROM (SELECT *, row_number() OVER (PARTITION BY {KEY}
                  ORDER BY CASE WHEN passenger_count < 0 THEN 1 ELSE passenger_count END
                           NULLS FIRST, trip_distance, fare_amount, tip_amount,
                           total_amount, payment_type) AS rn FROM dirty)
          WHERE rn = 1) GROUP BY route""",
)(
    lambda t: quality.dq_route(dirty(t), t.zones(), t.vendors())["all"]
    .groupBy("route")
    .agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("fare_amount").alias("fares"),
        F.sum("passenger_count").alias("passengers"),
    )
)

# --- scores and reports -------------------------------------------------------------

DBL_SCORE = f"* REPLACE ({dbl('quality_score')} AS quality_score)"
query("dq_results", ("dirty", *MASTERS), f"SELECT {DBL_SCORE} FROM ({DIRTY_RUN})")(dirty_results)
query(
    "dq_run_summary", ("dirty", *MASTERS), f"SELECT {DBL_SCORE} FROM ({summary_sql(DIRTY_RUN)})"
)(lambda t: quality.dq_run_summary(dirty_results(t)))


@query(
    "dq_gate",
    RUN_TABLES,
    f"""SELECT run_id, CASE WHEN status = 'PASS' THEN 'passed' ELSE 'stopped' END AS gate
        FROM ({summary_sql(ALL_RUNS)})""",
)
def _(t: Tables) -> DataFrame:
    """What the gate says to each of three runs."""
    summary = stored_summary(t)
    rows = []
    for run_id in ("20240101T000000", "20240102T000000", "20240103T000000"):
        try:
            quality.dq_gate(summary.filter(F.col("run_id") == run_id))
            rows.append((run_id, "passed"))
        except quality.QualityGateError:
            rows.append((run_id, "stopped"))
    return t.spark.createDataFrame(rows, "run_id string, gate string")


query("append_dq", RUN_TABLES, f"SELECT {DBL_SCORE} FROM ({ALL_RUNS})")(stored_results)
query(
    "latest_failed_rules",
    RUN_TABLES,
    f"""WITH r AS ({ALL_RUNS})
        SELECT rule_id, description, status, failed_rows FROM r
        WHERE run_id = (SELECT max(run_id) FROM r)""",
)(lambda t: quality.latest_failed_rules(stored_results(t)))
query(
    "dq_metrics",
    RUN_TABLES,
    f"""WITH s AS ({summary_sql(ALL_RUNS)})
        SELECT 'DataQuality' AS namespace, {ts('CAST(run_ts AS TIMESTAMP)')} AS ts,
               'QualityScore' AS metric, {dbl('quality_score')} AS value FROM s
        UNION ALL SELECT 'DataQuality', {ts('CAST(run_ts AS TIMESTAMP)')}, 'RejectedRows',
               {dbl('rejected_rows')} FROM s
        UNION ALL SELECT 'DataQuality', {ts('CAST(run_ts AS TIMESTAMP)')}, 'FailedRuleCount',
               {dbl('failed_rule_count')} FROM s""",
)(lambda t: quality.dq_metrics(stored_summary(t)))
query(
    "latest_dq_run",
    RUN_TABLES,
    f"SELECT {DBL_SCORE} FROM ({summary_sql(ALL_RUNS)}) ORDER BY run_ts DESC LIMIT 1",
)(lambda t: quality.latest_runs(stored_summary(t), 1))
query(
    "last_five_runs",
    RUN_TABLES,
    f"SELECT {DBL_SCORE} FROM ({summary_sql(ALL_RUNS)}) ORDER BY run_ts DESC LIMIT 5",
)(lambda t: quality.latest_runs(stored_summary(t), 5))
query(
    "quality_trend",
    RUN_TABLES,
    f"""SELECT run_ts, {dbl('quality_score')} AS quality_score, rejected_rows,
          {dbl('quality_score * 100')} AS quality_pct,
          CASE WHEN status = 'FAIL' THEN 1 ELSE 0 END AS is_fail
        FROM ({summary_sql(ALL_RUNS)})""",
)(lambda t: quality.quality_trend(stored_summary(t)))
