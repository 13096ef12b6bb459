"""The trip fact and its enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart import schemas
from tripmart.runtime import broadcast_if_small


def enrich_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Names of the pickup and the dropoff zone; the dimension plays two roles."""
    for key, role in (("pu_location_id", "pickup"), ("do_location_id", "dropoff")):
        side = zones.select(
            F.col("location_id").alias(key),
            F.col("borough").alias(f"{role}_borough"),
            F.col("zone_name").alias(f"{role}_zone"),
        )
        trips = trips.join(broadcast_if_small(side), key, "left")
    return trips


def enrich_vendor(trips: DataFrame, vendors: DataFrame) -> DataFrame:
    side = vendors.select("vendor_id", "vendor_name", "vendor_code")
    return trips.join(broadcast_if_small(side), "vendor_id", "left")


def trip_id() -> Column:
    """Hash of the natural key and the fare.

    Written with fixed formats: a number or time printed in another way would
    give another id. A NULL part is left out, as concat_ws does.
    """
    parts = [
        F.col("vendor_id").cast("string"),
        F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss"),
        F.date_format("dropoff_datetime", "yyyy-MM-dd HH:mm:ss"),
        F.col("pu_location_id").cast("string"),
        F.col("do_location_id").cast("string"),
        F.col("fare_amount").cast("decimal(18,2)").cast("string"),
    ]
    return F.sha2(F.concat_ws("|", *parts), 256)


def duration_minutes() -> Column:
    return (
        F.timestamp_diff("SECOND", F.col("pickup_datetime"), F.col("dropoff_datetime")) / F.lit(60.0)
    )


def build_fact(trips: DataFrame, zones: DataFrame, vendors: DataFrame) -> DataFrame:
    """Valid trips with zone and vendor names, duration, date and id."""
    return (
        enrich_vendor(enrich_zones(trips, zones), vendors)
        .withColumns(
            {
                "trip_duration_min": duration_minutes(),
                "pickup_date": F.to_date("pickup_datetime"),
                "trip_id": trip_id(),
            }
        )
    )


def fare_per_mile() -> Column:
    ratio = F.try_divide(F.col("fare_amount"), F.col("trip_distance"))
    return F.when(F.col("trip_distance") > 0, F.round(ratio, 2))


def tip_pct() -> Column:
    ratio = F.try_divide(F.col("tip_amount"), F.col("fare_amount"))
    return F.when(F.col("fare_amount") > 0, F.round(ratio, 4))


def enrich_fact(fact: DataFrame, zones: DataFrame, vendors: DataFrame) -> DataFrame:
    """The fact with names from the masters, where they have one, and measures.

    Names on the fact are the fallback for zones; vendor names come from the
    master alone.
    """
    old = ("pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")
    kept = fact.drop("vendor_name", "vendor_code").withColumnsRenamed({c: f"_{c}" for c in old})
    joined = enrich_vendor(enrich_zones(kept, zones), vendors)
    return joined.select(
        "trip_id",
        "vendor_id",
        "vendor_name",
        "vendor_code",
        "pickup_datetime",
        "dropoff_datetime",
        "passenger_count",
        "trip_distance",
        "pu_location_id",
        "do_location_id",
        *[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in old],
        "fare_amount",
        "tip_amount",
        "total_amount",
        "trip_duration_min",
        fare_per_mile().alias("fare_per_mile"),
        tip_pct().alias("tip_pct"),
        "pickup_date",
    )


def dedup_trips(trips: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """One row per natural key, the first in order.

    Ties are settled by all columns. Spark keeps only the best row of each key
    in every task before the shuffle, so copies of one trip do not pile up.
    """
    others = [F.col(c) for c in trips.columns if c not in schemas.TRIP_KEY]
    window = Window.partitionBy(*schemas.TRIP_KEY).orderBy(*(order or []), *others)
    return trips.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def clean_slice(
    trips: DataFrame,
    zones: DataFrame,
    vendors: DataFrame,
    month: str,
    size: int,
    seed: int = 42,
) -> DataFrame:
    """A repeatable sample of clean trips of one month, ordered by pickup.

    The rows with the smallest hash of key and seed are drawn, which is a top-n
    that every task can cut down by itself.
    """
    first = F.lit(month + "-01").cast("timestamp_ntz")
    known_zones = zones.filter("zone_name IS NOT NULL").select("location_id").distinct()
    known_vendors = vendors.select("vendor_id").distinct()
    clean = trips.filter(
        (F.col("pickup_datetime") >= first)
        & (F.col("pickup_datetime") < F.add_months(first.cast("date"), 1).cast("timestamp_ntz"))
        & (F.col("dropoff_datetime") > F.col("pickup_datetime"))
        & (F.col("fare_amount") >= 0)
        & (F.col("total_amount") >= 0)
        & (F.col("passenger_count") >= 1)
        & (F.col("trip_distance") > 0)
    )
    for side, key in (
        (known_vendors, "vendor_id"),
        (known_zones.withColumnRenamed("location_id", "pu_location_id"), "pu_location_id"),
        (known_zones.withColumnRenamed("location_id", "do_location_id"), "do_location_id"),
    ):
        clean = clean.join(broadcast_if_small(side), key, "left_semi")
    draw = F.md5(
        F.concat_ws(
            "|",
            F.col("vendor_id").cast("string"),
            F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss"),
            F.date_format("dropoff_datetime", "yyyy-MM-dd HH:mm:ss"),
            F.col("pu_location_id").cast("string"),
            F.col("do_location_id").cast("string"),
            F.lit(str(seed)),
        )
    )
    picked = dedup_trips(clean).withColumn("_draw", draw).orderBy("_draw").limit(size)
    return picked.orderBy("pickup_datetime", "_draw").drop("_draw")
