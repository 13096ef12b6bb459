"""Landing, standardising, enriching and reporting trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import QUERIES, avg2, day, dbl, half_up, query, ts
from checks.tables import Tables
from tripmart.operators import dimensions, facts
from tripmart.operators.standardize import (
    cast_trips,
    split_valid,
    standard_trips,
    std_columns,
    stg_trips,
    stg_vendor,
    stg_zone,
)
from tripmart.plans import analytics
from tripmart.runtime import cut, file_system, fresh_folder
from tripmart.schemas import TRIP_RENAMES, TRIP_TYPES
from tripmart.sinks.mirror import mirror_log, mirror_raw
from tripmart.sinks.snapshots import publish_snapshot
from tripmart.sinks.writers import append_rejects, gathered, land_raw, write_zone
from tripmart.sources.landing import drift_profile, incoming_manifest, lake_inventory
from tripmart.sources.readers import read_optional, read_reference, read_trips, register_catalog

TRIP_SQL = f"""
    vendor_id, {ts('pickup_datetime')} AS pickup_datetime,
    {ts('dropoff_datetime')} AS dropoff_datetime, passenger_count,
    {dbl('trip_distance')} AS trip_distance, pu_location_id, do_location_id,
    {dbl('fare_amount')} AS fare_amount, {dbl('tip_amount')} AS tip_amount,
    {dbl('total_amount')} AS total_amount, payment_type
"""
VALID = """(vendor_id IS NOT NULL AND pickup_datetime IS NOT NULL
    AND dropoff_datetime IS NOT NULL AND pu_location_id IS NOT NULL
    AND do_location_id IS NOT NULL AND fare_amount IS NOT NULL
    AND dropoff_datetime > pickup_datetime AND fare_amount >= 0
    AND coalesce(passenger_count, 0) >= 0)"""


def clean(t: Tables) -> DataFrame:
    return standard_trips(t.trips_landed().drop("l_orderkey"))


def dirty(t: Tables) -> DataFrame:
    return standard_trips(t.dirty_landed().drop("l_orderkey"))


def fact(t: Tables) -> DataFrame:
    valid, _ = split_valid(clean(t))
    return facts.build_fact(valid, t.zones(), t.vendors())


def dirty_with_id(t: Tables) -> DataFrame:
    return dirty(t).withColumn("trip_id", facts.trip_id())


# --- sources ----------------------------------------------------------------------


@query("read_trips", ("landed",), f"SELECT {TRIP_SQL} FROM landed")
def _(t: Tables) -> DataFrame:
    """Parquet and csv files side by side, read back as one table."""
    folder = fresh_folder(t.spark, "landed")
    trips = t.trips_landed()
    half = F.col("l_orderkey") % 2 == 0
    trips.filter(half).drop("l_orderkey").write.parquet(f"{folder}/a")
    trips.filter(~half).drop("l_orderkey").write.option("header", True).csv(f"{folder}/b")
    return standard_trips(read_trips(t.spark, folder))


@query(
    "read_reference",
    ("vendors",),
    "SELECT vendor_id, vendor_name, vendor_code, tech_provider FROM vendors",
)
def _(t: Tables) -> DataFrame:
    folder = fresh_folder(t.spark, "vendors")
    t.vendors().write.mode("append").option("header", True).csv(folder)
    return read_reference(t.spark, folder, t.vendors().schema)


@query(
    "read_optional",
    (),
    """SELECT 'present' AS tbl, count(*) AS rows FROM orders
       UNION ALL SELECT 'absent', 0""",
)
def _(t: Tables) -> DataFrame:
    found = {
        "present": read_optional(t.spark, f"{t.folder}/orders.parquet"),
        "absent": read_optional(t.spark, f"{t.folder}/not_there.parquet"),
    }
    parts = [
        (t.given("orders").limit(0) if df is None else df)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("tbl"), "rows")
        for name, df in found.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "external_tables",
    ("fact",),
    f"""SELECT {day('pickup_date')} AS pickup_date, count(*) AS trips,
               {dbl('sum(fare_amount)')} AS fares FROM fact
        GROUP BY pickup_date""",
)
def _(t: Tables) -> DataFrame:
    """A partitioned fact found through the catalog."""
    base = fresh_folder(t.spark, "catalog")
    write_zone(fact(t), f"{base}/curated/fact_trip", ("pickup_date",))
    register_catalog(t.spark, base, "ext_")
    return (
        t.spark.table("ext_fact_trip")
        .groupBy("pickup_date")
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").alias("fares"))
    )


@query(
    "external_tables_pruned",
    ("fact",),
    f"""SELECT {day('pickup_date')} AS pickup_date, count(*) AS trips,
               {dbl('sum(fare_amount)')} AS fares FROM fact
        WHERE month(pickup_date) = 2 GROUP BY pickup_date""",
)
def _(t: Tables) -> DataFrame:
    """The calendar's filter chooses the date folders of the fact."""
    base = fresh_folder(t.spark, "catalog")
    write_zone(fact(t), f"{base}/curated/fact_trip", ("pickup_date",))
    written = t.spark.read.parquet(f"{base}/curated/fact_trip")
    write_zone(dimensions.dim_date(written), f"{base}/curated/dim_date")
    register_catalog(t.spark, base, "pruned_")
    return t.spark.sql(
        """SELECT f.pickup_date, count(*) AS trips, sum(f.fare_amount) AS fares
           FROM pruned_fact_trip f JOIN pruned_dim_date d ON f.pickup_date = d.pickup_date
           WHERE d.month = 2 GROUP BY f.pickup_date"""
    )


@query(
    "incoming_manifest",
    ("landed",),
    """SELECT 'raw/trips/month=' || strftime(pickup_datetime, '%Y-%m') AS raw_folder,
              true AS valid, '' AS reason FROM landed GROUP BY 1
       UNION ALL
       SELECT 'raw/notes/year=' || strftime(pickup_datetime, '%Y'), false,
              'unsupported file type' FROM landed GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    """Verdicts on landed folders: one with parquet files per month, one with text per year."""
    base = fresh_folder(t.spark, "manifest")
    trips = t.trips_landed().select(
        F.date_format("tpep_pickup_datetime", "yyyy-MM").alias("month"), "VendorID"
    )
    write_zone(trips, f"{base}/incoming/trips", ("month",))
    notes = trips.select(F.substring("month", 1, 4).alias("year"), F.lit("note").alias("value"))
    write_zone(notes, f"{base}/incoming/notes", ("year",), "text")
    return (
        incoming_manifest(t.spark, base)
        .filter(F.col("raw_key").contains("part-"))
        .select(
            F.regexp_extract("raw_key", r"^(.*)/[^/]+$", 1).alias("raw_folder"),
            "valid",
            F.coalesce("reason", F.lit("")).alias("reason"),
        )
        .distinct()
    )


@query(
    "schema_drift",
    ("landed",),
    """SELECT 'rate_code_id' AS "column", 'missing' AS kind, NULL AS lost_values
       UNION ALL SELECT 'passenger_gender', 'extra', NULL
       UNION ALL SELECT 'fare_amount', 'retyped',
              (SELECT count(*) FROM landed WHERE l_orderkey % 10 = 3)""",
)
def _(t: Tables) -> DataFrame:
    """A drifted feed: one column missing, one extra, one turned into text with junk."""
    junk = F.col("l_orderkey") % 10 == 3
    feed = (
        t.trips_landed()
        .withColumn(
            "fare_amount", F.when(junk, "n/a").otherwise(F.col("fare_amount").cast("string"))
        )
        .withColumn("passenger_gender", F.lit("x"))
    )
    expected = T.StructType(
        [f for f in t.trips_landed().schema]
        + [T.StructField("rate_code_id", T.IntegerType())]
    )
    return drift_profile(feed, expected).select("column", "kind", "lost_values")


@query(
    "lake_inventory",
    ("fact", "vendors"),
    """SELECT 'curated' AS zone, count(*) AS rows,
              CAST(count(DISTINCT strftime(pickup_date, '%Y-%m')) AS BIGINT) AS partitions FROM fact
       UNION ALL SELECT 'processed', count(*), 0 FROM vendors
       UNION ALL SELECT 'raw', count(*), 1 FROM vendors
       UNION ALL SELECT 'master', count(*), 0 FROM vendors""",
)
def _(t: Tables) -> DataFrame:
    """Parquet and csv files, and a snapshot of which the second version is live."""
    base = fresh_folder(t.spark, "inventory")
    t.vendors().write.option("header", True).csv(f"{base}/raw/vendors/batch=1")
    for _ in range(2):
        publish_snapshot(t.vendors(), f"{base}/master/dim_vendor_scd2")
    # Trips move by month before they get names and ids.
    month = F.date_format(F.to_date("pickup_datetime"), "yyyy-MM")
    valid = split_valid(clean(t))[0].withColumn("month", month)
    by_month = facts.build_fact(gathered(valid, ("month",)), t.zones(), t.vendors())
    write_zone(by_month, f"{base}/curated/fact_trip", ("month",), gather=False)
    write_zone(t.vendors(), f"{base}/processed/vendors")
    return lake_inventory(t.spark, base).select("zone", "rows", "partitions")


# --- sinks ------------------------------------------------------------------------


@query(
    "write_zone",
    ("fact",),
    f"""SELECT trip_id, strftime(pickup_date, '%Y-%m') AS month,
               {dbl('total_amount')} AS total_amount FROM fact""",
)
def _(t: Tables) -> DataFrame:
    """Written once in full, then one year again as touched partitions only."""
    dest = fresh_folder(t.spark, "zone") + "/fact"
    month = F.date_format("pickup_date", "yyyy-MM")
    df = fact(t).select("trip_id", month.alias("month"), "total_amount")
    write_zone(df, dest, ("month",))
    write_zone(df.filter("month LIKE '1998-%'"), dest, ("month",), only_touched=True)
    return t.spark.read.schema("trip_id string, total_amount decimal(12,2), month string").parquet(dest)


REJECT_SQL = f"""SELECT {TRIP_SQL} FROM dirty WHERE NOT {VALID}"""


@query("append_rejects", ("dirty",), REJECT_SQL)
def _(t: Tables) -> DataFrame:
    dest = fresh_folder(t.spark, "rejects") + "/trips"
    _, rejected = split_valid(dirty(t))
    append_rejects(rejected, dest, "2024-03-01 00:00:00")
    return t.spark.read.parquet(dest).drop("_rejected_at", "reject_reason")


@query(
    "rejected_count",
    ("dirty",),
    f"""SELECT r AS rejected_at, count(*) AS rejected_rows FROM dirty,
        (VALUES ('2024-03-01 00:00:00'), ('2024-03-02 00:00:00')) AS v(r)
        WHERE NOT {VALID} GROUP BY r""",
)
def _(t: Tables) -> DataFrame:
    """Rejects of two runs, counted by run."""
    dest = fresh_folder(t.spark, "rejects") + "/trips"
    _, rejected = split_valid(dirty(t))
    for at in ("2024-03-01 00:00:00", "2024-03-02 00:00:00"):
        append_rejects(rejected, dest, at)
    return analytics.rejected_count(t.spark.read.parquet(dest)).withColumnRenamed(
        "_rejected_at", "rejected_at"
    )


@query(
    "ctas_partitioned",
    ("fact",),
    f"SELECT {day('pickup_date')} AS pickup_date, count(*) AS trips FROM fact GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    dest = fresh_folder(t.spark, "ctas") + "/fact_trip_enriched"
    write_zone(
        facts.enrich_fact(fact(t), t.zones(), t.vendors()), dest, ("pickup_date",)
    )
    return t.spark.read.parquet(dest).groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trips"))


@query("raw_landing", ("landed",), f"SELECT {TRIP_SQL} FROM landed")
def _(t: Tables) -> DataFrame:
    """Trips read from the mirrored files."""
    base = fresh_folder(t.spark, "landing")
    t.trips_landed().drop("l_orderkey").write.parquet(f"{base}/incoming/trips/one")
    mirror_raw(t.spark, base, "b1")
    return standard_trips(read_trips(t.spark, f"{base}/raw/trips"))


@query("raw_landing_rows", ("landed",), f"SELECT {TRIP_SQL} FROM landed")
def _(t: Tables) -> DataFrame:
    """Trips of one batch as rows, files of different headers united by name."""
    base = fresh_folder(t.spark, "landing")
    t.trips_landed().drop("l_orderkey").write.parquet(f"{base}/incoming/trips/one")
    land_raw(t.spark, base, "trips", "b1")
    return standard_trips(read_trips(t.spark, f"{base}/raw/trips").drop("_landed_from"))


def one_file_a_segment(t: Tables, text: str):
    """Customers' lines in a csv file for each market segment."""
    return (
        t.given("customer")
        .select("c_mktsegment", F.concat_ws(",", "c_custkey", F.lit(text)).alias("line"))
        .repartition("c_mktsegment")
        .sortWithinPartitions("c_mktsegment", "line")
        .write.mode("overwrite")
        .partitionBy("c_mktsegment")
        .option("compression", "none")
    )


@query(
    "raw_mirror",
    (),
    """WITH s AS (SELECT c_mktsegment, sum(strlen(c_custkey::VARCHAR) + 5)::BIGINT AS bytes
                 FROM customer GROUP BY 1)
       SELECT v.batch, 'copied' AS status, count(*) AS files, sum(bytes)::BIGINT AS bytes
       FROM s, (VALUES ('1')) AS v(batch) GROUP BY 1
       UNION ALL SELECT '3', 'refused', count(*), sum(bytes)::BIGINT FROM s
       UNION ALL SELECT 'same bytes', 'raw', count(*), sum(bytes)::BIGINT FROM s""",
)
def _(t: Tables) -> DataFrame:
    """Files of three batches: new ones, none new, and others under names that are taken.

    What lies in raw at the end is compared with what arrived first by the checksum of
    its bytes.
    """
    base = fresh_folder(t.spark, "mirror")
    one_file_a_segment(t, "new").text(f"{base}/lines")
    files = t.spark.read.format("binaryFile").option("recursiveFileLookup", True)

    def deliver(text: str) -> None:
        one_file_a_segment(t, text).text(f"{base}/lines")
        fs, _ = file_system(t.spark, base)
        path = t.spark._jvm.org.apache.hadoop.fs.Path
        for row in files.load(f"{base}/lines").select("path").collect():
            segment = row.path.split("c_mktsegment=")[1].split("/")[0]
            target = path(f"{base}/incoming/segments/{segment}/lines.csv")
            fs.mkdirs(target.getParent())
            fs.delete(target, False)
            fs.rename(path(row.path), target)

    def digests(folder: str) -> DataFrame:
        return files.load(folder).select(
            F.regexp_extract("path", "segments/(.*)$", 1).alias("name"),
            F.sha2("content", 256).alias("sha256"),
            "length",
        )

    deliver("new")
    first = cut(digests(f"{base}/incoming"))
    mirror_raw(t.spark, base, "1")
    mirror_raw(t.spark, base, "2")
    deliver("old")
    mirror_raw(t.spark, base, "3")
    there = digests(f"{base}/raw/segments").join(first, ["name", "sha256", "length"])
    log = mirror_log(t.spark, base).select("batch", "status", "length")
    return (
        log.unionByName(
            there.select(F.lit("same bytes").alias("batch"), F.lit("raw").alias("status"), "length")
        )
        .groupBy("batch", "status")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


# --- standardising ----------------------------------------------------------------


@query(
    "std_columns",
    ("landed",),
    f"""SELECT {TRIP_SQL}, l_orderkey AS order_key FROM landed""",
)
def _(t: Tables) -> DataFrame:
    return std_columns(t.trips_landed().withColumnRenamed("l_orderkey", " Order Key "), TRIP_RENAMES)


@query(
    "cast_trips",
    ("landed",),
    """SELECT count(*) AS trips,
              CAST(sum(CASE WHEN l_orderkey % 10 = 3 THEN 1 ELSE 0 END) AS BIGINT) AS null_fares,
              CAST(sum(CASE WHEN l_orderkey % 10 <> 3 THEN fare_amount END) AS DOUBLE) AS fares,
              CAST(sum(CASE WHEN l_orderkey % 9 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS null_pickups
       FROM landed""",
)
def _(t: Tables) -> DataFrame:
    """Text with junk in two columns; junk becomes NULL."""
    raw = std_columns(t.trips_landed(), TRIP_RENAMES)
    text = raw.select("l_orderkey", *[F.col(c).cast("string").alias(c) for c in TRIP_TYPES])
    junk = text.withColumns(
        {
            "fare_amount": F.when(F.col("l_orderkey") % 10 == 3, "n/a").otherwise(F.col("fare_amount")),
            "pickup_datetime": F.when(F.col("l_orderkey") % 9 == 2, "soon").otherwise(
                F.col("pickup_datetime")
            ),
        }
    )
    return cast_trips(junk).agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(F.col("fare_amount").isNull()).alias("null_fares"),
        F.sum("fare_amount").alias("fares"),
        F.count_if(F.col("pickup_datetime").isNull()).alias("null_pickups"),
    )


@query("valid_trips", ("dirty",), f"SELECT {TRIP_SQL} FROM dirty WHERE {VALID}")
def _(t: Tables) -> DataFrame:
    return split_valid(dirty(t))[0]


@query(
    "rejected_trips",
    ("dirty",),
    f"""SELECT {TRIP_SQL}, concat_ws(',',
          CASE WHEN vendor_id IS NULL THEN 'vendor_id is null' END,
          CASE WHEN dropoff_datetime <= pickup_datetime THEN 'dropoff not after pickup' END,
          CASE WHEN fare_amount < 0 THEN 'negative fare' END,
          CASE WHEN passenger_count < 0 THEN 'negative passenger_count' END) AS reject_reason
        FROM dirty WHERE NOT {VALID}""",
)
def _(t: Tables) -> DataFrame:
    return split_valid(dirty(t))[1]


STG_SQL = f"""trip_id, vendor_id, {ts('pickup_datetime')} AS pickup_datetime,
    {ts('dropoff_datetime')} AS dropoff_datetime, passenger_count,
    {dbl('trip_distance')} AS trip_distance, pu_location_id, do_location_id,
    {dbl('fare_amount')} AS fare_amount, {dbl('tip_amount')} AS tip_amount,
    {dbl('total_amount')} AS total_amount, pickup_borough, pickup_zone, dropoff_borough,
    dropoff_zone, vendor_name, {dbl('trip_duration_min')} AS trip_duration_min,
    {day('pickup_date')} AS pickup_date"""


@query("stg_trips", ("fact",), f"SELECT {STG_SQL} FROM fact")
def _(t: Tables) -> DataFrame:
    return stg_trips(fact(t))


FIRST_ZONE = """SELECT location_id,
    arg_min(borough, row_no) FILTER (borough IS NOT NULL) AS borough,
    arg_min(zone_name, row_no) FILTER (zone_name IS NOT NULL) AS zone_name,
    arg_min(service_zone, row_no) FILTER (service_zone IS NOT NULL) AS service_zone
    FROM zone_feed GROUP BY location_id"""
FIRST_VENDOR = """SELECT vendor_id,
    arg_min(vendor_name, row_no) FILTER (vendor_name IS NOT NULL) AS vendor_name,
    arg_min(vendor_code, row_no) FILTER (vendor_code IS NOT NULL) AS vendor_code
    FROM vendor_feed GROUP BY vendor_id"""


def first_zones(t: Tables) -> DataFrame:
    return dimensions.dim_zone(t.zone_feed(), [F.col("row_no")])


def first_vendors(t: Tables) -> DataFrame:
    return dimensions.dim_vendor(t.vendor_feed(), [F.col("row_no")])


query("stg_zone", ("zone_feed",), FIRST_ZONE)(lambda t: stg_zone(first_zones(t)))
query("stg_vendor", ("vendor_feed",), FIRST_VENDOR)(lambda t: stg_vendor(first_vendors(t)))
query("dim_zone", ("zone_feed",), FIRST_ZONE)(first_zones)
query("dim_vendor", ("vendor_feed",), FIRST_VENDOR)(first_vendors)
query(
    "dim_first_nonnull",
    ("zone_feed",),
    """SELECT location_id, arg_max(zone_name, row_no) FILTER (zone_name IS NOT NULL) AS zone_name
       FROM zone_feed GROUP BY location_id""",
)(
    lambda t: dimensions.first_nonnull(
        t.zone_feed().withColumn("_back", -F.col("row_no")), "location_id", ("zone_name",), [F.col("_back")]
    )
)


@query(
    "clean_slice",
    ("dirty", "zones", "vendors"),
    f"""SELECT {TRIP_SQL} FROM (
          SELECT *, md5(concat_ws('|', vendor_id, {ts('pickup_datetime')},
                 {ts('dropoff_datetime')}, pu_location_id, do_location_id, '42')) AS draw
          FROM (
            SELECT *, row_number() OVER (
                PARTITION BY vendor_id, pickup_datetime, dropoff_datetime,
                             pu_location_id, do_location_id
                ORDER BY passenger_count, trip_distance, fare_amount, tip_amount,
                         total_amount, payment_type) AS rn
            FROM dirty
            WHERE pickup_datetime >= TIMESTAMP '1998-03-01'
              AND pickup_datetime < TIMESTAMP '1998-04-01'
              AND dropoff_datetime > pickup_datetime AND fare_amount >= 0
              AND total_amount >= 0 AND passenger_count >= 1 AND trip_distance > 0
              AND vendor_id IN (SELECT vendor_id FROM vendors)
              AND pu_location_id IN (SELECT location_id FROM zones)
              AND do_location_id IN (SELECT location_id FROM zones))
          WHERE rn = 1 ORDER BY draw LIMIT 200)""",
)
def _(t: Tables) -> DataFrame:
    return facts.clean_slice(dirty(t), t.zones(), t.vendors(), "1998-03", 200)


@query(
    "dedup_trips",
    ("dirty",),
    f"""SELECT {TRIP_SQL} FROM (
          SELECT *, row_number() OVER (
                PARTITION BY vendor_id, pickup_datetime, dropoff_datetime,
                             pu_location_id, do_location_id
                ORDER BY passenger_count NULLS FIRST, trip_distance, fare_amount, tip_amount,
                         total_amount, payment_type) AS rn FROM dirty) WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    return facts.dedup_trips(dirty(t))


@query(
    "trip_measures",
    ("fact",),
    f"""SELECT trip_id,
          {half_up('fare_amount * 100', 'CAST(trip_distance * 100 AS BIGINT)', 2)} AS fare_per_mile,
          {half_up('tip_amount * 100', 'CAST(fare_amount * 100 AS BIGINT)', 4)} AS tip_pct
        FROM fact""",
)
def _(t: Tables) -> DataFrame:
    return fact(t).select(
        "trip_id",
        facts.fare_per_mile().alias("fare_per_mile"),
        facts.tip_pct().alias("tip_pct"),
    )


# --- joins and facts --------------------------------------------------------------

ZONE_NAMES = "pickup_borough, pickup_zone, dropoff_borough, dropoff_zone"


@query(
    "enrich_zones",
    ("dirty_id", "zones"),
    """SELECT trip_id, zp.borough AS pickup_borough, zp.zone_name AS pickup_zone,
              zd.borough AS dropoff_borough, zd.zone_name AS dropoff_zone
       FROM dirty_id LEFT JOIN zones zp ON zp.location_id = pu_location_id
       LEFT JOIN zones zd ON zd.location_id = do_location_id""",
)
def _(t: Tables) -> DataFrame:
    return facts.enrich_zones(dirty_with_id(t), t.zones()).select(
        "trip_id", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone"
    )


@query(
    "enrich_vendor",
    ("dirty_id", "vendors"),
    """SELECT trip_id, vendor_name, vendor_code
       FROM dirty_id t LEFT JOIN vendors v ON v.vendor_id = t.vendor_id""",
)
def _(t: Tables) -> DataFrame:
    return facts.enrich_vendor(dirty_with_id(t), t.vendors()).select(
        "trip_id", "vendor_name", "vendor_code"
    )


@query("fact_trip", ("fact",), f"SELECT {STG_SQL}, vendor_code, payment_type FROM fact")
def _(t: Tables) -> DataFrame:
    return fact(t)


@query("trip_id", ("dirty_id",), "SELECT trip_id FROM dirty_id")
def _(t: Tables) -> DataFrame:
    return dirty_with_id(t).select("trip_id")


@query(
    "fact_trip_enriched",
    ("fact", "zone_feed", "vendor_feed"),
    f"""SELECT trip_id, f.vendor_id, v.vendor_name, v.vendor_code,
          {ts('pickup_datetime')} AS pickup_datetime, {ts('dropoff_datetime')} AS dropoff_datetime,
          passenger_count, {dbl('trip_distance')} AS trip_distance, pu_location_id, do_location_id,
          coalesce(p.borough, pickup_borough) AS pickup_borough,
          coalesce(p.zone_name, pickup_zone) AS pickup_zone,
          coalesce(d.borough, dropoff_borough) AS dropoff_borough,
          coalesce(d.zone_name, dropoff_zone) AS dropoff_zone,
          {dbl('fare_amount')} AS fare_amount, {dbl('tip_amount')} AS tip_amount,
          {dbl('total_amount')} AS total_amount, {dbl('trip_duration_min')} AS trip_duration_min,
          {half_up('fare_amount * 100', 'CAST(trip_distance * 100 AS BIGINT)', 2)} AS fare_per_mile,
          {half_up('tip_amount * 100', 'CAST(fare_amount * 100 AS BIGINT)', 4)} AS tip_pct,
          {day('pickup_date')} AS pickup_date
        FROM fact f LEFT JOIN ({FIRST_ZONE}) p ON p.location_id = pu_location_id
        LEFT JOIN ({FIRST_ZONE}) d ON d.location_id = do_location_id
        LEFT JOIN ({FIRST_VENDOR}) v ON v.vendor_id = f.vendor_id""",
)
def _(t: Tables) -> DataFrame:
    return facts.enrich_fact(fact(t), first_zones(t), first_vendors(t))


@query(
    "master_coalesce",
    ("fact", "zone_feed"),
    f"""SELECT coalesce(p.zone_name, pickup_zone) AS pickup_zone, count(*) AS trips
        FROM fact LEFT JOIN (SELECT * FROM ({FIRST_ZONE}) WHERE location_id % 2 = 0) p
          ON p.location_id = pu_location_id GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    """The master knows every second zone only; the fact's own names fill in."""
    known = first_zones(t).filter("location_id % 2 = 0")
    return (
        facts.enrich_fact(fact(t), known, first_vendors(t))
        .groupBy("pickup_zone")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


@query(
    "dim_date",
    ("fact",),
    f"""SELECT DISTINCT {day('pickup_date')} AS pickup_date,
          CAST(strftime(pickup_date, '%Y%m%d') AS INTEGER) AS date_key,
          year(pickup_date) AS year, month(pickup_date) AS month, day(pickup_date) AS day,
          dayname(pickup_date) AS day_of_week, isodow(pickup_date) IN (6, 7) AS is_weekend
        FROM fact""",
)
def _(t: Tables) -> DataFrame:
    return dimensions.dim_date(fact(t))


@query(
    "dim_date_sql",
    ("fact",),
    f"""SELECT DISTINCT {day('pickup_date')} AS date_value,
          CAST(strftime(pickup_date, '%Y%m%d') AS INTEGER) AS date_key,
          year(pickup_date) AS year, month(pickup_date) AS month, day(pickup_date) AS day,
          isodow(pickup_date) AS day_of_week_num, dayname(pickup_date) AS day_of_week_name,
          isodow(pickup_date) IN (6, 7) AS is_weekend
        FROM fact WHERE pickup_date IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    return dimensions.dim_date_numbered(fact(t))


query(
    "distinct_dates", ("fact",), f"SELECT DISTINCT {day('pickup_date')} AS pickup_date FROM fact"
)(lambda t: dimensions.distinct_dates(fact(t)))


# --- reports ----------------------------------------------------------------------

query(
    "kpis",
    ("fact",),
    f"""SELECT count(*) AS total_trips, {dbl('sum(total_amount)')} AS total_revenue,
          {avg2('fare_amount')} AS avg_fare, {avg2('trip_distance')} AS avg_distance_mi
        FROM fact""",
)(lambda t: analytics.kpis(fact(t)))
query(
    "trips_by_borough",
    ("fact",),
    f"""SELECT pickup_borough, count(*) AS trips, {dbl('sum(total_amount)')} AS revenue
        FROM fact GROUP BY pickup_borough""",
)(lambda t: analytics.trips_by_borough(fact(t)))
query(
    "trips_by_vendor",
    ("fact",),
    f"""SELECT vendor_name, count(*) AS trips, {avg2('fare_amount')} AS avg_fare
        FROM fact GROUP BY vendor_name""",
)(lambda t: analytics.trips_by_vendor(fact(t)))
query(
    "top_routes",
    ("fact",),
    f"""SELECT pickup_zone, dropoff_zone, count(*) AS trips, {avg2('fare_amount')} AS avg_fare,
          {avg2('tip_amount')} AS avg_tip
        FROM fact GROUP BY pickup_zone, dropoff_zone
        ORDER BY trips DESC, pickup_zone, dropoff_zone LIMIT 15""",
)(lambda t: analytics.top_routes(fact(t)))
query(
    "daily_trend",
    ("fact",),
    f"""SELECT {day('pickup_date')} AS pickup_date, count(*) AS trips,
          {dbl('sum(total_amount)')} AS revenue FROM fact GROUP BY 1""",
)(lambda t: analytics.daily_trend(fact(t)))
query(
    "hourly_profile",
    ("fact",),
    "SELECT hour(pickup_datetime) AS pickup_hour, count(*) AS trips FROM fact GROUP BY 1",
)(lambda t: analytics.hourly_profile(fact(t)))


@query(
    "kpi_headline",
    ("fact",),
    f"""SELECT count(*) AS total_trips, {dbl('sum(total_amount)')} AS total_revenue,
          {avg2('fare_amount', 4)} AS avg_fare FROM fact""",
)
def _(t: Tables) -> DataFrame:
    return analytics.kpi_headline(fact(t)).withColumn("avg_fare", F.round("avg_fare", 4))


query(
    "borough_month",
    ("fact",),
    f"""SELECT pickup_borough, year(pickup_date) AS year, month(pickup_date) AS month,
          count(*) AS trips, {dbl('sum(total_amount)')} AS revenue FROM fact GROUP BY 1, 2, 3""",
)(lambda t: analytics.borough_month(fact(t), dimensions.dim_date_numbered(fact(t))))


@query(
    "tip_rate",
    ("fact",),
    f"""SELECT pickup_borough,
          {half_up('sum(tip_amount) * 100', 'CAST(sum(fare_amount) * 100 AS HUGEINT)', 6)} AS tip_rate
        FROM fact GROUP BY GROUPING SETS ((pickup_borough), ())""",
)
def _(t: Tables) -> DataFrame:
    """By borough and in total (borough NULL)."""
    both = analytics.tip_rate(fact(t), ("pickup_borough",), with_total=True)
    return both.withColumn("tip_rate", F.round("tip_rate", 6))


query(
    "borough_share",
    ("fact",),
    f"""SELECT pickup_borough, trips,
          {half_up('trips * 100', 'CAST(all_trips AS HUGEINT)', 2)} AS trip_share,
          {half_up('revenue * 10000', 'CAST(all_revenue * 100 AS HUGEINT)', 2)} AS revenue_share
        FROM (SELECT pickup_borough, count(*) AS trips, sum(total_amount) AS revenue
              FROM fact GROUP BY 1),
             (SELECT count(*) AS all_trips, sum(total_amount) AS all_revenue FROM fact)""",
)(lambda t: analytics.borough_share(fact(t)))


# Labels and measures of the named reports.
REPORTS = {
    "kpis": ((), ("total_trips", "total_revenue", "avg_fare", "avg_distance_mi")),
    "trips_by_borough": (("pickup_borough",), ("trips", "revenue")),
    "trips_by_vendor": (("vendor_name",), ("trips", "avg_fare")),
    "top_routes": (("pickup_zone", "dropoff_zone"), ("trips", "avg_fare", "avg_tip")),
    "daily_trend": (("pickup_date",), ("trips", "revenue")),
    "hourly_profile": (("pickup_hour",), ("trips",)),
}


def report_sql(name: str, labels: tuple[str, ...], measures: tuple[str, ...]) -> str:
    """A report's own SQL with a row for each of its measures."""
    label = f"concat_ws('|', {', '.join(f'{c}::VARCHAR' for c in labels)})" if labels else "''"
    names, values = ", ".join(f"'{m}'" for m in measures), ", ".join(map(dbl, measures))
    return f"""SELECT '{name}' AS query, {label} AS label, unnest([{names}]) AS measure,
        unnest([{values}]) AS value FROM ({QUERIES[name].sql})"""


@query(
    "named_query", (), " UNION ALL ".join(report_sql(name, *how) for name, how in REPORTS.items())
)
def _(t: Tables) -> DataFrame:
    """All reports by name over the registered fact, a row for each of their measures."""
    cut(fact(t)).createOrReplaceTempView("named_fact_trip")
    parts = []
    for name in analytics.available_queries():
        labels, measures = REPORTS[name]
        each = [
            F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
            for m in measures
        ]
        parts.append(
            analytics.named_query(t.spark, name, "named_").select(
                F.lit(name).alias("query"),
                F.concat_ws("|", *[F.col(c).cast("string") for c in labels]).alias("label"),
                F.inline(F.array(*each)),
            )
        )
    return reduce(DataFrame.unionByName, parts)
