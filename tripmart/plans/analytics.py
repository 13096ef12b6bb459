"""Reports over the trip fact and the master data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

def _trips() -> Column:
    return F.count(F.lit(1)).alias("trips")


def _money(column: str, name: str) -> Column:
    return F.round(F.sum(column), 2).alias(name)


def kpis(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_trips"),
        _money("total_amount", "total_revenue"),
        F.round(F.avg("fare_amount"), 2).alias("avg_fare"),
        F.round(F.avg("trip_distance"), 2).alias("avg_distance_mi"),
    )


def trips_by_borough(fact: DataFrame) -> DataFrame:
    """NULL is a borough of its own."""
    return (
        fact.groupBy("pickup_borough")
        .agg(_trips(), _money("total_amount", "revenue"))
        .orderBy(F.desc("trips"), "pickup_borough")
    )


def trips_by_vendor(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("vendor_name")
        .agg(_trips(), F.round(F.avg("fare_amount"), 2).alias("avg_fare"))
        .orderBy(F.desc("trips"), "vendor_name")
    )


def top_routes(fact: DataFrame, n: int = 15) -> DataFrame:
    """The busiest zone pairs; equal numbers of trips are ordered by zone names."""
    return (
        fact.groupBy("pickup_zone", "dropoff_zone")
        .agg(
            _trips(),
            F.round(F.avg("fare_amount"), 2).alias("avg_fare"),
            F.round(F.avg("tip_amount"), 2).alias("avg_tip"),
        )
        .orderBy(F.desc("trips"), "pickup_zone", "dropoff_zone")
        .limit(n)
    )


def daily_trend(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("pickup_date")
        .agg(_trips(), _money("total_amount", "revenue"))
        .orderBy("pickup_date")
    )


def hourly_profile(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy(F.hour("pickup_datetime").alias("pickup_hour"))
        .agg(_trips())
        .orderBy("pickup_hour")
    )


def kpi_headline(fact: DataFrame) -> DataFrame:
    """Unrounded totals of the warehouse fact."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("fare_amount").alias("avg_fare"),
    )


def borough_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Trips and revenue by borough and month, over the conformed calendar.

    Trips are summed up per borough and date before they meet the calendar.
    """
    daily = fact.groupBy("pickup_borough", "pickup_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amount")
    )
    calendar = dates.select(F.col("date_value").alias("pickup_date"), "year", "month")
    return (
        daily.join(calendar, "pickup_date")
        .groupBy("pickup_borough", "year", "month")
        .agg(F.sum("n").alias("trips"), F.sum("amount").alias("revenue"))
        .orderBy(F.desc("trips"), "pickup_borough", "year", "month")
    )


def vendor_performance(fact: DataFrame, vendor_history: DataFrame) -> DataFrame:
    """Trips by current vendor name, summed up per vendor before the join."""
    per_vendor = fact.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("fare_amount").alias("fares"),
        F.sum("fare_amount").alias("fare"),
        F.sum("tip_amount").alias("tips"),
    )
    names = vendor_history.filter("is_current").select(
        F.col("natural_key").alias("vendor_id"), "vendor_name"
    )
    return (
        per_vendor.join(names, "vendor_id")
        .groupBy("vendor_name")
        .agg(
            F.sum("n").alias("trips"),
            F.try_divide(F.sum("fare"), F.sum("fares")).alias("avg_fare"),
            F.sum("tips").alias("total_tips"),
        )
        .orderBy(F.desc("trips"), "vendor_name")
    )


def tip_rate(fact: DataFrame, by: tuple[str, ...] = (), with_total: bool = False) -> DataFrame:
    """Tips over fares, in total or by group; ``with_total`` adds the total to the groups."""
    rate = F.try_divide(F.sum("tip_amount"), F.sum("fare_amount")).alias("tip_rate")
    if not with_total:
        return fact.groupBy(*by).agg(rate)
    columns = [F.col(c) for c in by]
    # Tips and fares are sums already when the total is formed: one pass over the fact.
    return fact.groupingSets([columns, []], *columns).agg(rate)


def borough_share(fact: DataFrame) -> DataFrame:
    """Percent of all trips and of all revenue by borough."""
    per = fact.groupBy("pickup_borough").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("revenue")
    )
    # One row a borough is left here; their sum is the total.
    every = Window.partitionBy()
    trips = F.sum(F.col("trips").cast("decimal(18,0)")).over(every).cast("decimal(18,0)")
    revenue = F.sum("revenue").over(every)
    percent = F.lit(100).cast("decimal(3,0)")
    return per.select(
        "pickup_borough",
        "trips",
        F.round(F.try_divide(F.col("trips").cast("decimal(18,0)") * percent, trips), 2).alias(
            "trip_share"
        ),
        F.round(F.try_divide(F.col("revenue") * percent, revenue), 2).alias("revenue_share"),
    )


def golden_count(histories: dict[str, DataFrame]) -> DataFrame:
    """Current natural keys per domain."""
    return _tagged(histories).filter("is_current").groupBy("domain").agg(
        F.count_distinct("natural_key").alias("golden_records")
    )


def current_vs_history(histories: dict[str, DataFrame]) -> DataFrame:
    return _tagged(histories).groupBy("domain", "is_current").agg(
        F.count(F.lit(1)).alias("versions")
    )


def _tagged(histories: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.select(F.lit(name).alias("domain"), "natural_key", "is_current")
        for name, df in histories.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def scd2_changes_by_month(history: DataFrame) -> DataFrame:
    """Closed versions by the month they began."""
    return (
        history.filter("NOT is_current")
        .groupBy(F.date_trunc("month", "valid_from").cast("date").alias("month"))
        .agg(F.count(F.lit(1)).alias("versions"))
        .orderBy("month")
    )


def change_history(history: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """All versions, by key and time."""
    return history.select(
        "natural_key", *columns, "is_current", "valid_from", "valid_to"
    ).orderBy("natural_key", "valid_from")


def rejected_count(rejects: DataFrame) -> DataFrame:
    """Rejected rows by the time of their run."""
    return rejects.groupBy("_rejected_at").agg(F.count(F.lit(1)).alias("rejected_rows"))


NAMED: dict[str, Callable[[DataFrame], DataFrame]] = {
    "kpis": kpis,
    "trips_by_borough": trips_by_borough,
    "trips_by_vendor": trips_by_vendor,
    "top_routes": top_routes,
    "daily_trend": daily_trend,
    "hourly_profile": hourly_profile,
}


def available_queries() -> list[str]:
    return list(NAMED)


def named_query(spark: SparkSession, name: str, prefix: str = "") -> DataFrame:
    """A named report over the registered fact; ``KeyError`` for an unknown name."""
    return NAMED[name](spark.table(prefix + "fact_trip"))
