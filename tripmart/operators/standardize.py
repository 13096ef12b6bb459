"""Names, types and validity of trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas


def std_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by mapping, and the rest to lower case with underscores."""
    return df.toDF(
        *[mapping.get(c, c).strip().lower().replace(" ", "_") for c in df.columns]
    )


def cast_trips(df: DataFrame, **types: str) -> DataFrame:
    """Cast the typed trip columns; a value that does not fit becomes NULL."""
    wanted = {**schemas.TRIP_TYPES, **types}
    return df.select(
        *[
            F.col(c).try_cast(wanted[c]).alias(c) if c in wanted else F.col(c)
            for c in df.columns
        ]
    )


def standard_trips(raw: DataFrame) -> DataFrame:
    return cast_trips(std_columns(raw, schemas.TRIP_RENAMES))


def stg_trips(fact: DataFrame) -> DataFrame:
    """Typed staging projection of the trip fact."""
    types = {
        **schemas.TRIP_TYPES,
        "trip_duration_min": "double",
        "pickup_date": "date",
    }
    names = (
        "trip_id",
        *schemas.TRIP_TYPES,
        "pickup_borough",
        "pickup_zone",
        "dropoff_borough",
        "dropoff_zone",
        "vendor_name",
        "trip_duration_min",
        "pickup_date",
    )
    return fact.select(
        *[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in names]
    )


def stg_zone(dim_zone: DataFrame) -> DataFrame:
    return dim_zone.select(
        F.col("location_id").cast("int").alias("location_id"),
        "borough",
        "zone_name",
        "service_zone",
    )


def stg_vendor(dim_vendor: DataFrame) -> DataFrame:
    return dim_vendor.select(
        F.col("vendor_id").cast("int").alias("vendor_id"), "vendor_name", "vendor_code"
    )


def _defects() -> list[tuple[str, Column]]:
    """Each way a trip can be invalid; none of the conditions is ever NULL."""
    missing = [(f"{c} is null", F.col(c).isNull()) for c in schemas.REQUIRED]
    wrong = [
        ("dropoff not after pickup", F.col("dropoff_datetime") <= F.col("pickup_datetime")),
        ("negative fare", F.col("fare_amount") < 0),
        ("negative passenger_count", F.col("passenger_count") < 0),
    ]
    return missing + [(name, F.coalesce(cond, F.lit(False))) for name, cond in wrong]


def split_valid(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected trips; together they are the input, without overlap."""
    defects = _defects()
    bad = reduce(lambda a, b: a | b, [cond for _, cond in defects])
    reasons = F.filter(
        F.array(*[F.when(cond, F.lit(name)) for name, cond in defects]),
        lambda r: r.isNotNull(),
    )
    return trips.filter(~bad), trips.filter(bad).withColumn("reject_reason", reasons)
