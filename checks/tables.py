"""Taxi-like tables derived from the given ones, in Spark and, alike, in SQL.

``spark_tables`` gives the frames, ``with_tables`` the same as common table
expressions. Times stay without zone; money is cast to decimal on input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.runtime import cut


class Tables:
    """Lazily derived frames over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._landed: DataFrame | None = None

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def park_trips(self) -> None:
        """Join the trips once, for a query that reads them several times."""
        if self._landed is None:
            self._landed = cut(self.trips_landed())

    def trips_landed(self) -> DataFrame:
        """Clean trips under their landing names."""
        if self._landed is not None:
            return self._landed
        p = F.col("l_extendedprice").cast("decimal(12,2)")
        d = F.col("l_discount").cast("decimal(4,2)")
        x = F.col("l_tax").cast("decimal(4,2)")
        one = F.lit(1).cast("decimal(1,0)")
        places = (
            self.given("orders")
            .select("o_orderkey", "o_custkey", "o_orderdate")
            .join(
                self.given("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"),
                "o_custkey",
            )
            .select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "c_nationkey")
        )
        minutes = F.make_dt_interval(mins=(F.col("l_partkey") % 1440).cast("int"))
        ride = F.make_dt_interval(mins=F.col("l_quantity").cast("int"))
        # Two facts meet: neither side is ever small enough to broadcast at scale.
        return (
            self.given("lineitem")
            .drop("l_returnflag", "l_linestatus", "l_shipdate")
            .join(places.hint("merge"), "l_orderkey")
            .join(
                self.given("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"),
                "l_suppkey",
            )
            .withColumn("tpep_pickup_datetime", F.col("o_orderdate") + minutes)
            .select(
                "l_orderkey",
                F.col("l_suppkey").alias("VendorID"),
                "tpep_pickup_datetime",
                (F.col("tpep_pickup_datetime") + ride).alias("tpep_dropoff_datetime"),
                F.col("l_linenumber").cast("bigint").alias("passenger_count"),
                F.col("l_quantity").alias("trip_distance"),
                F.col("c_nationkey").cast("bigint").alias("PULocationID"),
                F.col("s_nationkey").cast("bigint").alias("DOLocationID"),
                p.alias("fare_amount"),
                F.round(p * x, 2).cast("decimal(12,2)").alias("tip_amount"),
                F.round(p * (one - d) * (one + x), 2).cast("decimal(12,2)").alias("total_amount"),
                (F.col("l_linenumber") % 4 + 1).cast("bigint").alias("payment_type"),
            )
        )

    def dirty_landed(self) -> DataFrame:
        """The same with defects chosen by order key."""

        def every(n: int):
            return F.col("l_orderkey") % n == 0

        def spoil(column: str, n: int, value):
            return F.when(every(n), value).otherwise(F.col(column))

        copies = F.when(every(79), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        ten = F.make_dt_interval(mins=F.lit(10))
        return (
            self.trips_landed()
            .withColumns(
                {
                    "tpep_dropoff_datetime": spoil(
                        "tpep_dropoff_datetime", 53, F.col("tpep_pickup_datetime") - ten
                    ),
                    "fare_amount": spoil("fare_amount", 59, -F.col("fare_amount")),
                    "VendorID": F.when(every(61), F.lit(None).cast("bigint"))
                    .when(every(67), F.col("VendorID") + 1_000_000)
                    .otherwise(F.col("VendorID")),
                    "DOLocationID": spoil("DOLocationID", 71, F.col("DOLocationID") + 9000),
                    "PULocationID": spoil("PULocationID", 83, F.col("PULocationID") + 9000),
                    "passenger_count": spoil("passenger_count", 73, -F.col("passenger_count")),
                    "_copy": F.explode(copies),
                }
            )
            .drop("_copy")
        )

    def zones(self) -> DataFrame:
        nation = self.given("nation").join(
            self.given("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
        )
        return nation.select(
            F.col("n_nationkey").alias("location_id"),
            F.col("r_name").alias("borough"),
            F.col("n_name").alias("zone_name"),
            F.when(F.col("n_regionkey") == 0, "Yellow Zone")
            .when(F.col("n_regionkey") == 1, "Boro Zone")
            .otherwise("Airports")
            .alias("service_zone"),
        )

    def vendors(self) -> DataFrame:
        nation = self.given("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return (
            self.given("supplier")
            .join(nation, "s_nationkey")
            .select(
                F.col("s_suppkey").cast("int").alias("vendor_id"),
                F.col("s_name").alias("vendor_name"),
                F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("vendor_code"),
                F.col("n_name").alias("tech_provider"),
            )
        )

    def zone_feed(self) -> DataFrame:
        """Zone rows as many sources send them: one per customer, with gaps."""
        zones = self.zones().withColumnRenamed("location_id", "c_nationkey")

        def gap(column: str, n: int):
            return F.when(F.col("c_custkey") % n != 0, F.col(column)).alias(column)

        return (
            self.given("customer")
            .select("c_custkey", "c_nationkey")
            .join(zones, "c_nationkey")
            .select(
                F.col("c_custkey").alias("row_no"),
                F.col("c_nationkey").alias("location_id"),
                gap("borough", 2),
                F.when(
                    F.col("c_custkey") % 3 != 0,
                    F.concat(F.col("zone_name"), F.lit("."), (F.col("c_custkey") % 5).cast("string")),
                ).alias("zone_name"),
                gap("service_zone", 5),
            )
        )

    def vendor_feed(self) -> DataFrame:
        """Vendor rows with repeats and gaps: one per customer."""
        return self.given("customer").select(
            F.col("c_custkey").alias("row_no"),
            (F.col("c_custkey") % 97).cast("int").alias("vendor_id"),
            F.when(F.col("c_custkey") % 2 != 0, F.col("c_name")).alias("vendor_name"),
            F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("vendor_code"),
        )

    def master_zones(self, snapshot: int) -> DataFrame:
        """Customers as zone master; snapshot 1 has changes, losses and additions."""
        nation = self.given("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        rows = (
            self.given("customer")
            .join(nation, "c_nationkey")
            .select(
                F.col("c_custkey").cast("int").alias("location_id"),
                F.col("c_mktsegment").alias("borough"),
                F.col("c_name").alias("zone_name"),
                F.col("n_name").alias("service_zone"),
            )
        )
        if snapshot == 0:
            return rows
        key = F.col("location_id")
        changed = rows.filter(key % 11 != 0).withColumn(
            "borough", F.when(key % 7 == 0, F.concat(F.col("borough"), F.lit("*"))).otherwise(F.col("borough"))
        )
        added = rows.filter(key % 13 == 0).withColumn("location_id", key + 10_000_000)
        return changed.unionByName(added)

    def master_vendors(self, snapshot: int) -> DataFrame:
        """Suppliers as vendor master, changed in the same way."""
        rows = self.vendors()
        if snapshot == 0:
            return rows
        key = F.col("vendor_id")
        changed = rows.filter(key % 11 != 0).withColumn(
            "tech_provider",
            F.when(key % 7 == 0, F.concat(F.col("tech_provider"), F.lit("*"))).otherwise(
                F.col("tech_provider")
            ),
        )
        added = rows.filter(key % 13 == 0).withColumn("vendor_id", key + 10_000_000)
        return changed.unionByName(added)

    def names(self) -> DataFrame:
        """Product names with typing variants, as records to be matched."""
        brand = F.regexp_extract("p_brand", r"(\d+)", 1)
        kind = F.col("p_partkey") % 6
        return self.given("part").select(
            F.col("p_partkey").alias("id"),
            F.when(kind == 0, F.col("p_name"))
            .when(kind == 1, F.concat(F.upper("p_name"), F.lit("  Inc.")))
            .when(kind == 2, F.concat(F.lit("The "), F.regexp_replace("p_name", " ", "-")))
            .when(kind == 3, F.concat(F.regexp_replace("p_name", "i", ""), F.lit(", LLC")))
            .when(kind == 4, F.concat_ws(" ", "p_name", brand))
            .otherwise(F.concat_ws(" ", F.lower("p_type"), F.col("p_name")))
            .alias("name"),
        )

    def vendor_records(self) -> DataFrame:
        """A type-1 vendor master with one record per part; groups by key."""
        key = F.col("p_partkey")
        source = (
            F.when(key % 4 == 0, "tlc_registry")
            .when(key % 4 == 1, "Partner_Feed")
            .when(key % 4 == 2, "manual_entry")
        )
        return self.given("part").select(
            key.alias("vendor_pk"),
            F.floor(key / 3).cast("int").alias("vendor_id"),
            F.when(key % 5 != 0, F.concat_ws(" ", "p_name", F.lit("Inc"))).alias("vendor_name"),
            F.when(key % 7 == 0, "").otherwise(F.col("p_brand")).alias("vendor_code"),
            F.when(key % 2 == 0, F.col("p_type")).alias("tech_provider"),
            F.when(key % 3 == 0, F.concat(F.lit("p"), key.cast("string"), F.lit("@x.org"))).alias(
                "contact_email"
            ),
            source.alias("source_system"),
            (
                F.lit("2024-01-01").cast("timestamp_ntz")
                + F.make_dt_interval(days=(key * 7 % 31).cast("int"))
            ).alias("updated_at"),
        )

    def merge_instructions(self) -> DataFrame:
        """Every second group of three records merges into its middle one."""
        key = F.col("p_partkey")
        group = F.floor(key / 3).cast("bigint")
        return (
            self.given("part")
            .filter((group % 2 == 0) & (key % 3 == 1))
            .select(key.alias("survivor_id"), F.array(key - 1, key + 1).alias("duplicate_ids"))
        )

    def metrics(self) -> DataFrame:
        """Events as metric values."""
        kind = F.col("event_type")
        return self.given("events").select(
            F.when(kind == "error", "AWS/Lambda")
            .when(kind.isin("click", "view"), "AWS/ApiGateway")
            .otherwise("DataQuality")
            .alias("namespace"),
            F.when(kind == "error", "Errors")
            .when(kind == "click", "4XXError")
            .when(kind == "view", "5XXError")
            .when(kind == "purchase", "RejectedRows")
            .otherwise("QualityScore")
            .alias("metric"),
            "ts",
            F.col("value").cast("decimal(12,2)").alias("value"),
        )


# --- the same in SQL ------------------------------------------------------------------

SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "landed": (
        (),
        """
        SELECT l_orderkey, l_suppkey AS vendor_id,
               o_orderdate + to_minutes(l_partkey % 1440) AS pickup_datetime,
               o_orderdate + to_minutes(l_partkey % 1440)
                 + to_minutes(CAST(l_quantity AS BIGINT)) AS dropoff_datetime,
               CAST(l_linenumber AS BIGINT) AS passenger_count,
               CAST(l_quantity AS DECIMAL(10,2)) AS trip_distance,
               CAST(c_nationkey AS BIGINT) AS pu_location_id,
               CAST(s_nationkey AS BIGINT) AS do_location_id,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS fare_amount,
               CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2))
                 * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) AS tip_amount,
               CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2))
                 * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(4,2)))
                 * (CAST(1 AS DECIMAL(3,2)) + CAST(l_tax AS DECIMAL(4,2))), 2)
                 AS DECIMAL(12,2)) AS total_amount,
               CAST(l_linenumber % 4 + 1 AS BIGINT) AS payment_type
        FROM lineitem
        JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey
        JOIN supplier ON s_suppkey = l_suppkey
        """,
    ),
    "dirty": (
        ("landed",),
        """
        SELECT l_orderkey,
               CASE WHEN l_orderkey % 61 = 0 THEN NULL
                    WHEN l_orderkey % 67 = 0 THEN vendor_id + 1000000
                    ELSE vendor_id END AS vendor_id,
               pickup_datetime,
               CASE WHEN l_orderkey % 53 = 0 THEN pickup_datetime - to_minutes(10)
                    ELSE dropoff_datetime END AS dropoff_datetime,
               CASE WHEN l_orderkey % 73 = 0 THEN -passenger_count
                    ELSE passenger_count END AS passenger_count,
               trip_distance,
               CASE WHEN l_orderkey % 83 = 0 THEN pu_location_id + 9000
                    ELSE pu_location_id END AS pu_location_id,
               CASE WHEN l_orderkey % 71 = 0 THEN do_location_id + 9000
                    ELSE do_location_id END AS do_location_id,
               CASE WHEN l_orderkey % 59 = 0 THEN -fare_amount
                    ELSE fare_amount END AS fare_amount,
               tip_amount, total_amount, payment_type
        FROM landed, (VALUES (1), (2)) AS c(copy)
        WHERE copy = 1 OR l_orderkey % 79 = 0
        """,
    ),
    "zones": (
        (),
        """
        SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone_name,
               CASE n_regionkey WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone'
                    ELSE 'Airports' END AS service_zone
        FROM nation JOIN region ON r_regionkey = n_regionkey
        """,
    ),
    "vendors": (
        (),
        """
        SELECT CAST(s_suppkey AS INTEGER) AS vendor_id, s_name AS vendor_name,
               'V' || s_suppkey AS vendor_code, n_name AS tech_provider
        FROM supplier JOIN nation ON n_nationkey = s_nationkey
        """,
    ),
    "fact": (
        ("landed", "zones", "vendors"),
        """
        SELECT t.*, zp.borough AS pickup_borough, zp.zone_name AS pickup_zone,
               zd.borough AS dropoff_borough, zd.zone_name AS dropoff_zone,
               v.vendor_name, v.vendor_code,
               date_diff('second', pickup_datetime, dropoff_datetime) / 60.0 AS trip_duration_min,
               CAST(pickup_datetime AS DATE) AS pickup_date,
               sha256(concat_ws('|', t.vendor_id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'),
                 strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S'), pu_location_id,
                 do_location_id, CAST(fare_amount AS DECIMAL(18,2)))) AS trip_id
        FROM (SELECT * FROM landed
              WHERE dropoff_datetime > pickup_datetime AND fare_amount >= 0
                AND passenger_count >= 0) t
        LEFT JOIN zones zp ON zp.location_id = pu_location_id
        LEFT JOIN zones zd ON zd.location_id = do_location_id
        LEFT JOIN vendors v ON v.vendor_id = t.vendor_id
        """,
    ),
    "dirty_id": (
        ("dirty",),
        """
        SELECT *, sha256(concat_ws('|', vendor_id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'),
                 strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S'), pu_location_id,
                 do_location_id, CAST(fare_amount AS DECIMAL(18,2)))) AS trip_id
        FROM dirty
        """,
    ),
    "zone_feed": (
        ("zones",),
        """
        SELECT c_custkey AS row_no, c_nationkey AS location_id,
               CASE WHEN c_custkey % 2 <> 0 THEN borough END AS borough,
               CASE WHEN c_custkey % 3 <> 0
                    THEN zone_name || '.' || (c_custkey % 5) END AS zone_name,
               CASE WHEN c_custkey % 5 <> 0 THEN service_zone END AS service_zone
        FROM customer JOIN zones ON location_id = c_nationkey
        """,
    ),
    "vendor_feed": (
        (),
        """
        SELECT c_custkey AS row_no, CAST(c_custkey % 97 AS INTEGER) AS vendor_id,
               CASE WHEN c_custkey % 2 <> 0 THEN c_name END AS vendor_name,
               CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS vendor_code
        FROM customer
        """,
    ),
    "zone_master_0": (
        (),
        """
        SELECT CAST(c_custkey AS INTEGER) AS location_id, c_mktsegment AS borough,
               c_name AS zone_name, n_name AS service_zone
        FROM customer JOIN nation ON n_nationkey = c_nationkey
        """,
    ),
    "zone_master_1": (
        ("zone_master_0",),
        """
        SELECT location_id,
               CASE WHEN location_id % 7 = 0 THEN borough || '*' ELSE borough END AS borough,
               zone_name, service_zone
        FROM zone_master_0 WHERE location_id % 11 <> 0
        UNION ALL
        SELECT location_id + 10000000, borough, zone_name, service_zone
        FROM zone_master_0 WHERE location_id % 13 = 0
        """,
    ),
    "vendor_master_1": (
        ("vendors",),
        """
        SELECT vendor_id, vendor_name, vendor_code,
               CASE WHEN vendor_id % 7 = 0 THEN tech_provider || '*'
                    ELSE tech_provider END AS tech_provider
        FROM vendors WHERE vendor_id % 11 <> 0
        UNION ALL
        SELECT vendor_id + 10000000, vendor_name, vendor_code, tech_provider
        FROM vendors WHERE vendor_id % 13 = 0
        """,
    ),
    "names": (
        (),
        r"""
        SELECT p_partkey AS id,
               CASE p_partkey % 6
                 WHEN 0 THEN p_name
                 WHEN 1 THEN upper(p_name) || '  Inc.'
                 WHEN 2 THEN 'The ' || replace(p_name, ' ', '-')
                 WHEN 3 THEN replace(p_name, 'i', '') || ', LLC'
                 WHEN 4 THEN p_name || ' ' || regexp_extract(p_brand, '(\d+)', 1)
                 ELSE lower(p_type) || ' ' || p_name END AS name
        FROM part
        """,
    ),
    "vendor_records": (
        (),
        """
        SELECT p_partkey AS vendor_pk, CAST(p_partkey // 3 AS INTEGER) AS vendor_id,
               CASE WHEN p_partkey % 5 <> 0 THEN p_name || ' Inc' END AS vendor_name,
               CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_brand END AS vendor_code,
               CASE WHEN p_partkey % 2 = 0 THEN p_type END AS tech_provider,
               CASE WHEN p_partkey % 3 = 0 THEN 'p' || p_partkey || '@x.org' END AS contact_email,
               CASE p_partkey % 4 WHEN 0 THEN 'tlc_registry' WHEN 1 THEN 'Partner_Feed'
                    WHEN 2 THEN 'manual_entry' END AS source_system,
               TIMESTAMP '2024-01-01' + to_days(CAST(p_partkey * 7 % 31 AS INTEGER)) AS updated_at
        FROM part
        """,
    ),
    "standing": (
        ("vendor_records",),
        """
        SELECT *, vendor_id AS grp,
               (CASE WHEN coalesce(vendor_name, '') = '' THEN 1 ELSE 0 END
                + CASE WHEN coalesce(vendor_code, '') = '' THEN 1 ELSE 0 END
                + CASE WHEN coalesce(tech_provider, '') = '' THEN 1 ELSE 0 END
                + CASE WHEN coalesce(contact_email, '') = '' THEN 1 ELSE 0 END) AS empties,
               CASE lower(source_system) WHEN 'tlc_registry' THEN 3 WHEN 'partner_feed' THEN 2
                    WHEN 'manual_entry' THEN 1 ELSE 0 END AS trust
        FROM vendor_records
        """,
    ),
    "ranked": (
        ("standing",),
        """
        SELECT *, row_number() OVER (PARTITION BY grp
                 ORDER BY empties, trust DESC, updated_at DESC, vendor_pk) AS rank
        FROM standing
        """,
    ),
    "golden": (
        ("ranked",),
        """
        SELECT grp,
               arg_min(vendor_name, rank) FILTER (coalesce(vendor_name, '') <> '') AS vendor_name,
               arg_min(vendor_code, rank) FILTER (coalesce(vendor_code, '') <> '') AS vendor_code,
               arg_min(tech_provider, rank)
                 FILTER (coalesce(tech_provider, '') <> '') AS tech_provider,
               arg_min(contact_email, rank)
                 FILTER (coalesce(contact_email, '') <> '') AS contact_email,
               arg_min(vendor_pk, rank) AS survivor_id,
               count(*) AS source_count
        FROM ranked GROUP BY grp
        """,
    ),
    "merged": (
        ("golden", "vendor_records"),
        """
        SELECT v.vendor_pk, v.vendor_id,
               CASE WHEN g.grp IS NULL THEN v.vendor_name ELSE g.vendor_name END AS vendor_name,
               CASE WHEN g.grp IS NULL THEN v.vendor_code ELSE g.vendor_code END AS vendor_code,
               CASE WHEN g.grp IS NULL THEN v.tech_provider
                    ELSE g.tech_provider END AS tech_provider,
               CASE WHEN g.grp IS NULL THEN v.contact_email
                    ELSE g.contact_email END AS contact_email,
               v.source_system,
               CASE WHEN g.grp IS NULL THEN v.updated_at
                    ELSE TIMESTAMP '2024-03-01' END AS updated_at
        FROM vendor_records v
        LEFT JOIN golden g ON g.grp = v.vendor_id AND v.vendor_id % 2 = 0
          AND v.vendor_pk % 3 = 1
        WHERE NOT (v.vendor_id % 2 = 0 AND v.vendor_pk % 3 <> 1
                   AND EXISTS (SELECT 1 FROM part WHERE p_partkey = 3 * v.vendor_id + 1))
        """,
    ),
    "metrics": (
        (),
        """
        SELECT CASE WHEN event_type = 'error' THEN 'AWS/Lambda'
                    WHEN event_type IN ('click', 'view') THEN 'AWS/ApiGateway'
                    ELSE 'DataQuality' END AS namespace,
               CASE event_type WHEN 'error' THEN 'Errors' WHEN 'click' THEN '4XXError'
                    WHEN 'view' THEN '5XXError' WHEN 'purchase' THEN 'RejectedRows'
                    ELSE 'QualityScore' END AS metric,
               ts, CAST(value AS DECIMAL(12,2)) AS value
        FROM events
        """,
    ),
}


def with_tables(names: tuple[str, ...], body: str) -> str:
    """``body`` behind the definitions of the named tables and of what they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        needs, _ = SQL[name]
        for need in needs:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    parts = ",\n".join(f"{name} AS ({SQL[name][1]})" for name in order)
    if not parts:
        return body
    body = body.strip()
    # A body with definitions of its own continues the list.
    for start in ("WITH RECURSIVE", "WITH"):
        if body.startswith(start):
            return f"{start} {parts}, {body[len(start) :]}"
    return f"WITH {parts}\n{body}"
