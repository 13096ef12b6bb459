"""A filter on a joined dimension leaves out files of the fact."""

from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.sinks.writers import write_zone
from tripmart.sources.readers import register_catalog


def table(spark, name, rows):
    """Rows with the columns of a catalog table; those not given are NULL."""
    fields = [f.split() for f in schemas.CATALOG[name][1].replace(", ", "|").split("|")]
    return rows.select(
        *[
            (F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in fields
        ]
    )


def test_a_filter_on_the_calendar_prunes_folders(spark, tmp_path):
    days = spark.range(60).selectExpr("date_add(date'2024-01-01', cast(id as int)) pickup_date")
    calendar = days.withColumn("month", F.month("pickup_date"))
    trips = days.withColumn("fare_amount", F.lit(1)).crossJoin(spark.range(3).drop("id"))
    write_zone(
        table(spark, "fact_trip", trips), f"{tmp_path}/curated/fact_trip", ("pickup_date",)
    )
    write_zone(table(spark, "dim_date", calendar), f"{tmp_path}/curated/dim_date")
    register_catalog(spark, str(tmp_path), "p_")
    spark.conf.set("spark.sql.adaptive.enabled", False)  # to look into the plan as it ran
    try:
        found = spark.sql(
            """SELECT sum(f.fare_amount) AS fares FROM p_fact_trip f
               JOIN p_dim_date d ON f.pickup_date = d.pickup_date WHERE d.month = 2"""
        )
        assert found.collect()[0].fares == 29 * 3
        plan = found._jdf.queryExecution().executedPlan()
        assert "dynamicpruning" in plan.toString()
        leaves = plan.collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        folders = [
            s.metrics().apply("numPartitions").value()
            for s in scans
            if s.metrics().contains("numPartitions")
        ]
        assert folders == [29]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
