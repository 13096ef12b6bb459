"""One batch from landed files to the warehouse."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.operators import dimensions, facts, key_index, quality, scd2
from tripmart.operators.standardize import split_valid, standard_trips, std_columns
from tripmart.plans import monitoring, warehouse
from tripmart.runtime import (
    broadcast_if_small,
    counted,
    cut,
    file_system,
    is_small,
    rows_seen,
    session_setting,
)
from tripmart.sinks.snapshots import publish_snapshot, read_snapshot, snapshot_exists
from tripmart.sinks.writers import append_run, gathered, land_raw, write_zone
from tripmart.sources.readers import read_optional, read_trips

STEPS = ("land", "etl", "quality", "gate", "transform", "history", "warehouse", "rejects")
# Keeps the partition value a text, whatever the run's id looks like.
BATCH = "b-"


@dataclass
class RunReport:
    """What each step did; steps after a failed gate are skipped."""

    run_id: str
    steps: list[tuple[str, str, int]] = field(default_factory=list)
    error: str | None = None

    def add(self, step: str, rows: int, status: str = "done") -> None:
        self.steps.append((step, status, rows))

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.run_id, *step) for step in self.steps],
            "run_id string, step string, status string, rows bigint",
        )


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
MONTH_ROWS = 500_000  # rows of a month that one task sorts and writes
MONTHS_APART = 240  # each is a part of the plan


def listing_by_cores(spark: SparkSession):
    """Folders of a table are listed by a few tasks a core, not by a task each.

    A table with a folder a date has thousands of them, and each is listed in no time.
    """
    most = 4 * spark.sparkContext.defaultParallelism
    return session_setting(spark, LISTING, min(int(spark.conf.get(LISTING)), most))


def _masters(spark: SparkSession, base: str, run_id: str) -> None:
    """Processed masters from this batch's files; without new ones they stay."""
    for source, schema, renames in (
        ("taxi_zones", schemas.ZONE_CSV, schemas.ZONE_RENAMES),
        ("vendors", schemas.VENDOR_CSV, {}),
    ):
        landed = f"{base}/raw/{source}/batch={run_id}"
        fs, path = file_system(spark, landed)
        if fs.exists(path):
            rows = read_trips(spark, landed).drop("_landed_from")
            typed = rows.select(
                *[
                    F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
                    for f in schema
                    if f.name in rows.columns
                ]
            )
            write_zone(std_columns(typed, renames), f"{base}/processed/{source}")


def touched_dates(spark: SparkSession, base: str, run_id: str) -> DataFrame:
    """The pickup dates of this batch's valid trips.

    Kept in the shared folder: joins go by the size of the dates, not of the trips.
    """
    return cut(
        spark.read.parquet(f"{base}/processed/yellow_taxi")
        .filter(F.col("batch") == F.lit(BATCH + run_id))
        .select(F.to_date("pickup_datetime").alias("pickup_date"))
        .distinct()
    )


def etl(
    spark: SparkSession, base: str, run_id: str, run_ts: str
) -> tuple[int, int, DataFrame, DataFrame]:
    """Raw to processed and curated; numbers of valid and rejected trips of the batch.

    Also the dates that the batch touches, and its keys that other batches have as well.

    Trips are kept by batch, and a batch that runs again replaces itself. Of the fact only
    the dates of this batch are built anew, from the trips of all batches; a trip that
    several batches have brought is taken from the first of them by name.
    """
    trips = standard_trips(
        read_trips(spark, f"{base}/raw/yellow_taxi/batch={run_id}").drop("_landed_from")
    ).withColumn("batch", F.lit(BATCH + run_id))
    valid, rejected = split_valid(trips)
    valid, seen_valid = counted(valid, "valid")
    rejected, seen_rejected = counted(rejected, "rejected")
    processed = f"{base}/processed/yellow_taxi"
    # A single batch: gathering it by name would move every trip to no end.
    write_zone(valid, processed, ("batch",), only_touched=True, gather=False)
    write_zone(
        rejected.withColumn("_rejected_at", F.lit(run_ts).cast("timestamp")),
        f"{base}/processed/rejected/yellow_taxi",
        ("batch",),
        only_touched=True,
        gather=False,
    )
    _masters(spark, base, run_id)

    # From here on the written tables are read, so nothing is computed twice.
    zones = spark.read.parquet(f"{base}/processed/taxi_zones")
    vendors = spark.read.parquet(f"{base}/processed/vendors")
    write_zone(dimensions.dim_zone(zones), f"{base}/curated/dim_zone")
    write_zone(dimensions.dim_vendor(vendors), f"{base}/curated/dim_vendor")
    zones = spark.read.parquet(f"{base}/curated/dim_zone")
    vendors = spark.read.parquet(f"{base}/curated/dim_vendor")
    dates = touched_dates(spark, base, run_id)
    day = F.to_date("pickup_datetime") == F.col("pickup_date")
    stored = spark.read.option("mergeSchema", True).parquet(processed)
    own = stored.filter(F.col("batch") == F.lit(BATCH + run_id))
    key_index.index_batch(own, base)
    index = key_index.read_index(spark, base)
    months = index.filter(F.col("batch") == F.lit(BATCH + run_id)).select("pickup_month")
    shared = key_index.shared_keys(index, months)
    copies = shared.where("batch <> first").select("digest", "batch")
    trips = key_index.without_later_copies(
        stored.join(broadcast_if_small(dates), day, "left_semi"), copies
    ).drop("batch")
    # Trips move before they get names and ids, unless a join has to move them anyway.
    narrow = is_small(zones) and is_small(vendors)
    if narrow:
        trips = gathered(
            trips.withColumn("pickup_date", F.to_date("pickup_datetime")), ("pickup_date",)
        )
    write_zone(
        facts.build_fact(trips, zones, vendors),
        f"{base}/curated/fact_trip",
        ("pickup_date",),
        only_touched=True,
        gather=not narrow,
    )
    fact = spark.read.parquet(f"{base}/curated/fact_trip")
    write_zone(dimensions.dim_date(fact), f"{base}/curated/dim_date")
    return rows_seen(seen_valid), rows_seen(seen_rejected), dates, shared


def check(
    spark: SparkSession,
    base: str,
    run_id: str,
    run_ts: str,
    threshold: float,
    shared: DataFrame | None = None,
) -> DataFrame:
    """Judge the batch's valid trips, keep results and summary; the run's summary.

    A trip that another batch has brought as well counts as a duplicate. ``shared`` has
    the keys of several batches, where they are known already.
    """
    trips = read_optional(spark, f"{base}/processed/yellow_taxi")
    if trips is None:
        raise FileNotFoundError("no processed trips, the ETL must run first")
    index = key_index.read_index(spark, base)
    if shared is None:
        own = index.filter(F.col("batch") == F.lit(BATCH + run_id))
        shared = key_index.shared_keys(index, own.select("pickup_month"))
    results = quality.dq_results(
        trips.filter(F.col("batch") == F.lit(BATCH + run_id)).drop("batch"),
        read_optional(spark, f"{base}/processed/taxi_zones"),
        read_optional(spark, f"{base}/processed/vendors"),
        run_id,
        run_ts,
        keys=key_index.batch_keys(index, shared, BATCH + run_id),
    )
    append_run(results, f"{base}/curated/dq_results", run_id)
    stored = spark.read.parquet(f"{base}/curated/dq_results").filter(F.col("run_id") == run_id)
    summary = quality.dq_run_summary(stored, threshold)
    append_run(summary, f"{base}/master/dq_run_summary", run_id)
    return spark.read.parquet(f"{base}/master/dq_run_summary").filter(F.col("run_id") == run_id)


def transform(spark: SparkSession, base: str, dates: DataFrame) -> int:
    """The enriched fact of these dates, and the SQL variant of the calendar."""
    fact = spark.read.parquet(f"{base}/curated/fact_trip")
    zones = spark.read.parquet(f"{base}/curated/dim_zone")
    vendors = spark.read.parquet(f"{base}/curated/dim_vendor")
    enriched, seen = counted(
        facts.enrich_fact(
            fact.join(broadcast_if_small(dates), "pickup_date", "left_semi"), zones, vendors
        ),
        "enriched",
    )
    # The fact lies by date; only joins that shuffle scatter the dates.
    write_zone(
        enriched,
        f"{base}/curated/fact_trip_enriched",
        ("pickup_date",),
        only_touched=True,
        gather=not (is_small(zones) and is_small(vendors)),
    )
    write_zone(dimensions.dim_date_numbered(fact), f"{base}/curated/dim_date_sql")
    return rows_seen(seen)


def version_master(spark: SparkSession, base: str, now: str) -> dict[str, DataFrame]:
    """New snapshots of the zone and vendor histories."""
    histories = {}
    for table, source, domain in (
        ("dim_zone_scd2", "taxi_zones", schemas.ZONES),
        ("dim_vendor_scd2", "vendors", schemas.VENDORS),
    ):
        dest = f"{base}/master/{table}"
        history = read_snapshot(spark, dest) if snapshot_exists(spark, dest) else None
        merged = scd2.scd2_merge(
            spark.read.parquet(f"{base}/processed/{source}"),
            history,
            domain.key_col,
            domain.history_attrs,
            now,
        )
        publish_snapshot(
            scd2.continue_surrogate_keys(merged, history, domain.history_attrs),
            dest,
            partition_by=("is_current",),
        )
        histories[table] = read_snapshot(spark, dest)
    return histories


def _month_after(month: dt.date) -> dt.date:
    return (month + dt.timedelta(days=31)).replace(day=1)


def by_month(fact: DataFrame, dates: DataFrame) -> DataFrame | None:
    """The fact of the months of these dates, a month in few tasks; no trip moves.

    The fact lies by date, so the folders of a month are read side by side, in tasks of
    about ``MONTH_ROWS`` rows. None where there are no months, or too many for one plan.
    """
    month = F.trunc("pickup_date", "month").alias("month")
    day = F.col("pickup_date")
    known = dates.where(day.isNotNull()).select(month).distinct()
    months = sorted(row.month for row in known.limit(MONTHS_APART + 1).collect())
    if not 0 < len(months) <= MONTHS_APART:
        return None
    span = fact.where((day >= months[0]) & (day < _month_after(months[-1])))
    rows = {row.month: row["count"] for row in span.groupBy(month).count().collect()}
    parts = [
        fact.where((day >= first) & (day < _month_after(first))).coalesce(
            -(-rows[first] // MONTH_ROWS)
        )
        for first in months
        if first in rows
    ]
    return reduce(DataFrame.unionByName, parts) if parts else None


def warehouse_inputs(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    calendar = spark.read.parquet(f"{base}/curated/dim_date_sql")
    return {
        "fact_trip": spark.read.parquet(f"{base}/curated/fact_trip_enriched"),
        "dim_date": calendar.withColumnRenamed("day_of_week_name", "day_of_week"),
        "dim_zone_scd2": read_snapshot(spark, f"{base}/master/dim_zone_scd2"),
        "dim_vendor_scd2": read_snapshot(spark, f"{base}/master/dim_vendor_scd2"),
        "dq_run_summary": spark.read.parquet(f"{base}/master/dq_run_summary"),
    }


def run_batch(
    spark: SparkSession,
    base: str,
    run_id: str,
    run_ts: str,
    threshold: float = schemas.DQ_THRESHOLD,
) -> RunReport:
    """Land, standardise, judge, enrich, version and load one batch.

    What earlier batches brought stays. A failed quality gate ends the run; what
    follows is reported as skipped. Every step reports rows: landed, valid, rejected,
    failed rules, enriched, versions, and rows in the warehouse; rows that the
    warehouse refuses are a step of their own. A run that broke off may run again.
    """
    with listing_by_cores(spark):
        return _run(spark, base, RunReport(run_id), run_ts, threshold)


def _run(
    spark: SparkSession, base: str, report: RunReport, run_ts: str, threshold: float
) -> RunReport:
    run_id = report.run_id
    landed = sum(
        land_raw(spark, base, source, run_id)
        for source in ("yellow_taxi", "taxi_zones", "vendors")
    )
    report.add("land", landed)
    valid, rejected, dates, shared = etl(spark, base, run_id, run_ts)
    report.add("etl", valid)
    summary = check(spark, base, run_id, run_ts, threshold, shared)
    report.add("quality", rejected)
    failed = summary.select("failed_rule_count").first()[0]
    try:
        quality.dq_gate(summary)
    except quality.QualityGateError as failure:
        report.error = str(failure)
        report.add("gate", failed, "failed")
        for step in STEPS[4:]:
            report.add(step, 0, "skipped")
        return report
    report.add("gate", failed)
    report.add("transform", transform(spark, base, dates))
    histories = version_master(spark, base, run_ts)
    report.add("history", sum(h.count() for h in histories.values()))
    tables = warehouse_inputs(spark, base)
    laid = by_month(tables["fact_trip"], dates)
    if laid is not None:
        tables["fact_trip"] = laid
    refused = sum(warehouse.load(tables, base, dates, laid is not None).values())
    counts = warehouse.load_counts(
        {name: spark.read.parquet(f"{base}/warehouse/{name}") for name in tables}
    )
    report.add("warehouse", sum(row.rows for row in counts.collect()))
    report.add("rejects", refused, "failed" if refused else "done")
    if refused:
        report.error = f"the warehouse refused {refused} rows, see warehouse/_rejects"
    return report


def run_alert(spark: SparkSession, base: str, report: RunReport) -> DataFrame:
    """The readable message about a run."""
    summary = spark.read.parquet(f"{base}/master/dq_run_summary").filter(
        F.col("run_id") == report.run_id
    )
    return monitoring.alert_rows(
        summary.select(
            "run_id",
            "quality_score",
            "rejected_rows",
            F.lit(report.error).cast("string").alias("error"),
            F.lit("FAILED" if report.error else "SUCCEEDED").alias("status"),
        )
    )
