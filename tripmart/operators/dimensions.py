"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_nonnull(
    df: DataFrame, key: str, attrs: tuple[str, ...], order: list[Column]
) -> DataFrame:
    """One row per key: for each attribute the first value in order that is not NULL.

    An aggregate with partial results, so a key with very many rows stays cheap.
    The attribute itself ends the order and settles ties.
    """
    return df.groupBy(key).agg(
        *[
            F.min_by(
                F.col(a), F.when(F.col(a).isNotNull(), F.struct(*order, F.col(a)))
            ).alias(a)
            for a in attrs
        ]
    )


def dim_zone(zones: DataFrame, order: list[Column] | None = None) -> DataFrame:
    return first_nonnull(zones, "location_id", ("borough", "zone_name", "service_zone"), order or [])


def dim_vendor(vendors: DataFrame, order: list[Column] | None = None) -> DataFrame:
    return first_nonnull(vendors, "vendor_id", ("vendor_name", "vendor_code"), order or [])


def distinct_dates(fact: DataFrame) -> DataFrame:
    return fact.select("pickup_date").distinct()


def dim_date(fact: DataFrame) -> DataFrame:
    """Calendar attributes of the dates that occur."""
    day = F.col("pickup_date")
    return distinct_dates(fact).select(
        day,
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def dim_date_numbered(fact: DataFrame) -> DataFrame:
    """The SQL variant: ISO weekday numbers beside the names, no NULL date."""
    day = F.col("pickup_date")
    return (
        distinct_dates(fact.filter(day.isNotNull()))
        .select(
            F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
            day.alias("date_value"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            (F.weekday(day) + 1).alias("day_of_week_num"),
            F.date_format(day, "EEEE").alias("day_of_week_name"),
            (F.weekday(day) >= 5).alias("is_weekend"),
        )
    )


def current_rows(history: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Current versions of a history table as golden dimension."""
    return history.filter("is_current").select(
        "surrogate_key", "natural_key", *columns, "valid_from"
    )


def as_of(history: DataFrame, moment: str) -> DataFrame:
    """Versions valid at a moment; the start belongs to the interval, the end not."""
    at = F.lit(moment).cast("timestamp_ntz")
    return history.filter((F.col("valid_from") <= at) & (at < F.col("valid_to")))
