"""Column types, domain settings and other fixed values.

Everything here is plain configuration; the operators take it as arguments or
defaults and hold no literals of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: trip columns ------------------------------------------------

TRIP_RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
}
ZONE_RENAMES = {
    "LocationID": "location_id",
    "Borough": "borough",
    "Zone": "zone_name",
}

# Money is decimal so that sums do not depend on the order of addition; pass
# overrides to cast_trips for other types.
TRIP_TYPES = {
    "vendor_id": "int",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "passenger_count": "int",
    "trip_distance": "decimal(10,2)",
    "pu_location_id": "int",
    "do_location_id": "int",
    "fare_amount": "decimal(12,2)",
    "tip_amount": "decimal(12,2)",
    "total_amount": "decimal(12,2)",
}

REQUIRED = (
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pu_location_id",
    "do_location_id",
    "fare_amount",
)
TRIP_KEY = (
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pu_location_id",
    "do_location_id",
)

ZONE_CSV = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)
VENDOR_CSV = T.StructType(
    [
        T.StructField("vendor_id", T.IntegerType()),
        T.StructField("vendor_name", T.StringType()),
        T.StructField("vendor_code", T.StringType()),
        T.StructField("tech_provider", T.StringType()),
        T.StructField("contact_email", T.StringType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("updated_at", T.DateType()),
    ]
)

LANDING_EXTENSIONS = ("parquet", "csv", "json")

# --- Fixed values: tables of the curated and master zones ----------------------

CATALOG = {
    "fact_trip": (
        "curated/fact_trip",
        "trip_id string, vendor_id int, pickup_datetime timestamp_ntz, "
        "dropoff_datetime timestamp_ntz, passenger_count int, "
        "trip_distance decimal(10,2), pu_location_id int, do_location_id int, "
        "pickup_borough string, pickup_zone string, dropoff_borough string, "
        "dropoff_zone string, vendor_name string, vendor_code string, "
        "fare_amount decimal(12,2), tip_amount decimal(12,2), "
        "total_amount decimal(12,2), trip_duration_min double, pickup_date date",
    ),
    "dim_date": (
        "curated/dim_date",
        "date_key int, pickup_date date, year int, month int, day int, "
        "day_of_week string, is_weekend boolean",
    ),
    "dim_zone": (
        "curated/dim_zone",
        "location_id int, borough string, zone_name string, service_zone string",
    ),
    "dim_vendor": (
        "curated/dim_vendor",
        "vendor_id int, vendor_name string, vendor_code string",
    ),
    "dq_results": (
        "curated/dq_results",
        "rule_id string, description string, failed_rows bigint, status string, "
        "run_id string, run_ts string, quality_score decimal(5,4), total_rows bigint",
    ),
    "dq_run_summary": (
        "master/dq_run_summary",
        "run_id string, run_ts string, quality_score decimal(5,4), total_rows bigint, "
        "rejected_rows bigint, failed_rule_count bigint, status string",
    ),
}
SNAPSHOTS = {
    "dim_zone_scd2": "master/dim_zone_scd2",
    "dim_vendor_scd2": "master/dim_vendor_scd2",
}

# --- Fixed values: data quality --------------------------------------------------

DQ_THRESHOLD = 0.95
DQ_MIN_ROWS = 1
DQ_RULES = (
    ("R01", "required columns not null"),
    ("R02", "pickup before dropoff"),
    ("R03", "fare_amount >= 0"),
    ("R04", "passenger_count >= 0"),
    ("R05", "vendor_id in master"),
    ("R06", "pickup_location_id in master"),
    ("R07", "dropoff_location_id in master"),
    ("R08", "duplicate trip detection"),
    ("R09", "row count >= {min_rows}"),
)
# rule, severity, action
DQ_ACTIONS = (
    ("R01", "high", "reject"),
    ("R02", "high", "quarantine"),
    ("R03", "high", "reject"),
    ("R04", "low", "auto-fix"),
    ("R05", "medium", "warn"),
    ("R06", "medium", "warn"),
    ("R07", "medium", "warn"),
    ("R08", "medium", "auto-fix"),
    ("R09", "high", "reject"),
)

# --- Fixed values: master data ----------------------------------------------------

STOP_WORDS = (
    "inc",
    "incorporated",
    "llc",
    "ltd",
    "co",
    "corp",
    "company",
    "technologies",
    "technology",
    "tech",
    "the",
)
SOURCE_TRUST = {"tlc_registry": 3, "partner_feed": 2, "manual_entry": 1}
MATCH_THRESHOLD = 0.80
HIGH_DATE = "9999-12-31 00:00:00"


@dataclass(frozen=True)
class Domain:
    """One kind of master data."""

    name: str
    id_col: str
    key_col: str
    match_col: str
    attrs: tuple[str, ...]
    history_attrs: tuple[str, ...]


ZONES = Domain(
    name="zones",
    id_col="zone_id",
    key_col="location_id",
    match_col="zone_name",
    attrs=("zone_name", "borough", "service_zone"),
    history_attrs=("borough", "zone_name", "service_zone"),
)
VENDORS = Domain(
    name="vendors",
    id_col="vendor_pk",
    key_col="vendor_id",
    match_col="vendor_name",
    attrs=("vendor_name", "vendor_code", "tech_provider", "contact_email"),
    history_attrs=("vendor_name", "vendor_code", "tech_provider"),
)

# --- Fixed values: warehouse layout -------------------------------------------------
# column -> (type, maximum length in bytes, nullable)

WAREHOUSE_FACT = {
    "trip_id": ("string", 64, False),
    "vendor_id": ("int", None, True),
    "vendor_name": ("string", 128, True),
    "vendor_code": ("string", 32, True),
    "pickup_datetime": ("timestamp_ntz", None, True),
    "dropoff_datetime": ("timestamp_ntz", None, True),
    "passenger_count": ("int", None, True),
    "trip_distance": ("decimal(8,2)", None, True),
    "pu_location_id": ("int", None, True),
    "do_location_id": ("int", None, True),
    "pickup_borough": ("string", 64, True),
    "pickup_zone": ("string", 128, True),
    "dropoff_borough": ("string", 64, True),
    "dropoff_zone": ("string", 128, True),
    "fare_amount": ("decimal(10,2)", None, True),
    "tip_amount": ("decimal(10,2)", None, True),
    "total_amount": ("decimal(10,2)", None, True),
    "trip_duration_min": ("decimal(10,2)", None, True),
    "fare_per_mile": ("decimal(10,2)", None, True),
    "tip_pct": ("decimal(6,4)", None, True),
    "pickup_date": ("date", None, True),
}
WAREHOUSE_DATE = {
    "date_key": ("int", None, False),
    "date_value": ("date", None, False),
    "year": ("smallint", None, True),
    "month": ("smallint", None, True),
    "day": ("smallint", None, True),
    "day_of_week": ("string", 12, True),
    "is_weekend": ("boolean", None, True),
}
_HISTORY_TAIL = {
    "valid_from": ("timestamp_ntz", None, True),
    "valid_to": ("timestamp_ntz", None, True),
    "is_current": ("boolean", None, True),
    "record_hash": ("string", 64, True),
    "created_at": ("timestamp_ntz", None, True),
    "updated_at": ("timestamp_ntz", None, True),
}
WAREHOUSE_ZONE = {
    "surrogate_key": ("bigint", None, False),
    "natural_key": ("int", None, False),
    "borough": ("string", 64, True),
    "zone_name": ("string", 128, True),
    "service_zone": ("string", 64, True),
    **_HISTORY_TAIL,
}
WAREHOUSE_VENDOR = {
    "surrogate_key": ("bigint", None, False),
    "natural_key": ("int", None, False),
    "vendor_name": ("string", 128, True),
    "vendor_code": ("string", 32, True),
    "tech_provider": ("string", 128, True),
    **_HISTORY_TAIL,
}
WAREHOUSE_SUMMARY = {
    "run_id": ("string", 32, True),
    "run_ts": ("string", 32, True),
    "quality_score": ("decimal(5,4)", None, True),
    "total_rows": ("bigint", None, True),
    "rejected_rows": ("bigint", None, True),
    "failed_rule_count": ("int", None, True),
    "status": ("string", 8, True),
}

# --- Fixed values: alarms -------------------------------------------------------------
# name, namespace, metric, statistic, comparison, threshold

ALARM_PERIOD_SECONDS = 300
ALARMS = (
    ("stepfunctions-failed", "AWS/States", "ExecutionsFailed", "Sum", ">=", 1.0),
    ("glue-etl-failed", "Glue", "glue.driver.aggregate.numFailedTasks", "Sum", ">=", 1.0),
    ("lambda-errors", "AWS/Lambda", "Errors", "Sum", ">=", 1.0),
    ("api-5xx", "AWS/ApiGateway", "5XXError", "Sum", ">=", 1.0),
    ("api-4xx", "AWS/ApiGateway", "4XXError", "Sum", ">=", 10.0),
    ("dq-score-low", "DataQuality", "QualityScore", "Minimum", "<", 0.95),
    ("rejected-rows-high", "DataQuality", "RejectedRows", "Maximum", ">", 100.0),
    ("redshift-load-failed", "Warehouse", "RedshiftLoadFailures", "Sum", ">=", 1.0),
)
