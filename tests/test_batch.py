"""Landing, rules, the batch run, alarms and plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import runtime
from tripmart.operators import quality
from tripmart.operators.dimensions import dim_zone
from tripmart.operators.facts import dedup_trips
from tripmart.operators.standardize import split_valid, standard_trips
from tripmart.plans import analytics, monitoring
from tripmart.plans.batch_run import run_alert, run_batch
from tripmart.sinks.writers import land_raw
from tripmart.sources.landing import incoming_manifest, schema_drift
from tripmart.sources.readers import read_optional, read_trips, register_catalog

HEADER = (
    "vendor_id,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,"
    "pu_location_id,do_location_id,fare_amount,tip_amount,total_amount,payment_type\n"
)
GOOD_TRIPS = """\
4,2023-09-03 06:10:00,2023-09-03 06:31:00,2,5.6,12,45,21.25,4.10,27.35,2
6,2023-09-03 07:05:30,2023-09-03 07:19:00,,1.8,45,77,9.75,0.0,11.25,1
4,2023-09-04 22:40:00,2023-09-04 23:02:15,3,7.05,90,12,33.5,6.7,44.2,1
"""
# Two bad times, a negative fare and a negative number of passengers are rejected; an unknown
# vendor, two unknown pickup zones and a trip that stands there three times break rules.
BAD_TRIPS = (
    HEADER
    + GOOD_TRIPS
    + """\
6,2023-09-03 08:00:00,2023-09-03 07:45:00,1,2.2,77,90,12.0,1.0,14.5,1
4,2023-09-03 08:30:00,2023-09-03 08:30:00,1,0.4,77,77,5.0,0.0,6.5,2
6,2023-09-03 09:10:00,2023-09-03 09:40:00,1,9.1,12,90,-30.0,0.0,-31.5,4
4,2023-09-03 10:00:00,2023-09-03 10:07:00,-2,1.1,45,12,7.0,0.0,8.5,2
31,2023-09-03 11:20:00,2023-09-03 11:44:00,1,4.4,90,45,18.25,2.0,22.75,1
6,2023-09-03 12:00:00,2023-09-03 12:09:00,1,1.6,501,45,8.5,1.5,12.5,1
6,2023-09-03 12:30:00,2023-09-03 12:52:00,2,3.9,502,77,16.0,0.0,18.5,2
4,2023-09-04 22:40:00,2023-09-04 23:02:15,3,7.05,90,12,33.5,6.7,44.2,1
4,2023-09-04 22:40:00,2023-09-04 23:02:15,3,7.05,90,12,33.5,6.7,44.2,1
"""
)
ZONES = "LocationID,Borough,Zone,service_zone\n" + "".join(
    f"{i},Northside,Quarter {i},Boro Zone\n" for i in (12, 45, 77, 90)
)
VENDORS = (
    "vendor_id,vendor_name,vendor_code,tech_provider,contact_email,source_system,updated_at\n"
    "4,Harbour Cabs,HBC,Meterworks,desk@harbour.example,partner_feed,2023-05-06\n"
    "6,Lantern Rides,LTR,Fareline,,partner_feed,2023-07-08\n"
)


def lake(tmp_path, trips):
    for source, text in (("yellow_taxi", trips), ("taxi_zones", ZONES), ("vendors", VENDORS)):
        folder = tmp_path / "incoming" / source
        folder.mkdir(parents=True)
        (folder / f"{source}.csv").write_text(text)
    return str(tmp_path)


def test_bad_file_stops_at_the_gate(spark, tmp_path):
    base = lake(tmp_path, BAD_TRIPS)
    report = run_batch(spark, base, "first", "2023-09-05 00:00:00")
    assert report.steps == [
        ("land", "done", 12 + 4 + 2),
        ("etl", "done", 8),
        ("quality", "done", 4),
        ("gate", "failed", 3),
        ("transform", "skipped", 0),
        ("history", "skipped", 0),
        ("warehouse", "skipped", 0),
        ("rejects", "skipped", 0),
    ]
    results = spark.read.parquet(f"{base}/curated/dq_results").collect()
    failed = {r.rule_id: r.failed_rows for r in results if r.status == "FAIL"}
    assert failed == {"R05": 1, "R06": 2, "R08": 2}
    summary = spark.read.parquet(f"{base}/master/dq_run_summary").first()
    assert (float(summary.quality_score), summary.status) == (0.6667, "FAIL")
    assert (summary.total_rows, summary.rejected_rows, summary.failed_rule_count) == (8, 5, 3)
    message = run_alert(spark, base, report).first().message
    assert message.startswith("[ALERT] tripmart pipeline: FAILED")
    assert "quality_score: 0.6667" in message and "error: quality gate failed" in message
    assert read_optional(spark, f"{base}/warehouse/fact_trip") is None


def test_good_file_reaches_the_warehouse(spark, tmp_path):
    base = lake(tmp_path, HEADER + GOOD_TRIPS)
    report = run_batch(spark, base, "first", "2023-09-05 00:00:00")
    assert report.error is None
    assert report.steps[-2:] == [("warehouse", "done", 3 + 2 + 4 + 2 + 1), ("rejects", "done", 0)]
    loaded = spark.read.parquet(f"{base}/warehouse/fact_trip")
    assert loaded.count() == 3
    assert loaded.schema["fare_amount"].dataType == T.DecimalType(10, 2)
    assert spark.read.parquet(f"{base}/warehouse/dim_zone_scd2").count() == 4
    names = register_catalog(spark, base, "good_")
    assert {"good_fact_trip", "good_dim_zone_scd2", "good_dq_run_summary"} <= set(names)
    kpis = analytics.named_query(spark, "kpis", "good_").first()
    assert (kpis.total_trips, float(kpis.total_revenue), float(kpis.avg_fare)) == (3, 82.8, 21.5)
    with pytest.raises(KeyError):
        analytics.named_query(spark, "nothing", "good_")
    assert "[OK]" in run_alert(spark, base, report).first().message


def test_later_batches_add_and_repeats_change_nothing(spark, tmp_path):
    base = lake(tmp_path, HEADER + GOOD_TRIPS)
    run_batch(spark, base, "first", "2023-09-05 00:00:00")
    more = tmp_path / "incoming" / "yellow_taxi" / "later"
    more.mkdir()
    (more / "second.CSV").write_text(
        HEADER + "6,2023-09-04 05:00:00,2023-09-04 05:12:00,1,2.5,77,45,13.0,1.0,16.0,1\n"
    )
    for _ in range(2):
        report = run_batch(spark, base, "second", "2023-09-06 00:00:00")
        assert report.error is None and report.steps[1] == ("etl", "done", 1)
        for table in ("curated/fact_trip", "curated/fact_trip_enriched", "warehouse/fact_trip"):
            rows = spark.read.parquet(f"{base}/{table}").collect()
            assert sorted(float(r.fare_amount) for r in rows) == [9.75, 13.0, 21.25, 33.5]
        assert spark.read.parquet(f"{base}/curated/dim_date").count() == 2
        assert spark.read.parquet(f"{base}/curated/dq_results").count() == 18


def test_a_trip_in_two_batches(spark, tmp_path):
    """Counted as a duplicate in each batch that is judged after, once in the fact."""
    base = lake(tmp_path, HEADER + GOOD_TRIPS)
    run_batch(spark, base, "first", "2023-09-05 00:00:00")
    again = GOOD_TRIPS.splitlines(keepends=True)[0]
    more = tmp_path / "incoming" / "yellow_taxi" / "later"
    more.mkdir()
    (more / "second.csv").write_text(
        HEADER + again + "6,2023-09-04 05:00:00,2023-09-04 05:12:00,1,2.5,77,45,13.0,1.0,16.0,1\n"
    )
    fares = None
    for _ in range(2):
        report = run_batch(spark, base, "second", "2023-09-06 00:00:00")
        assert report.steps[1] == ("etl", "done", 2) and "quality gate" in report.error
        rules = spark.read.parquet(f"{base}/curated/dq_results").where("run_id = 'second'")
        failed = {r.rule_id: r.failed_rows for r in rules.collect() if r.failed_rows}
        assert list(failed.values()) == [1] and "R08" in next(iter(failed))
        fares = sorted(float(r.fare_amount) for r in spark.read.parquet(f"{base}/curated/fact_trip").collect())
        assert fares == [9.75, 13.0, 21.25, 33.5]
    # The first batch, judged again, sees the copy as well, and its own trip stays.
    run_batch(spark, base, "first", "2023-09-05 00:00:00")
    rows = spark.read.parquet(f"{base}/curated/fact_trip").collect()
    assert sorted(float(r.fare_amount) for r in rows) == fares


def test_the_warehouse_keeps_what_it_refuses(spark, tmp_path):
    base = lake(tmp_path, HEADER + GOOD_TRIPS)
    vendors = tmp_path / "incoming" / "vendors" / "vendors.csv"
    vendors.write_text(VENDORS.replace("HBC", "H" * 40))
    report = run_batch(spark, base, "first", "2023-09-05 00:00:00")
    assert report.steps[-1] == ("rejects", "failed", 3) and "refused 3 rows" in report.error
    refused = spark.read.parquet(f"{base}/warehouse/_rejects/fact_trip").collect()
    assert {tuple(r.load_errors) for r in refused} == {("vendor_code too long",)}
    assert spark.read.parquet(f"{base}/warehouse/fact_trip").count() == 1


def test_landing_matches_columns_by_name(spark, tmp_path):
    base = lake(tmp_path, "a,fare,tip\n1,20,3\n")
    folder = tmp_path / "incoming" / "yellow_taxi"
    (folder / "other.CSV").write_text("a,tip,fare,extra\n2,4,30,x\n")
    (folder / "rows.json").write_text('{"a": 3, "fare": 40, "tip": 5}\n')
    spark.createDataFrame([("4", "50")], "a string, fare string").write.parquet(
        str(folder / "one")
    )
    spark.createDataFrame([("5", "6")], "a string, tip string").write.parquet(str(folder / "two"))
    assert land_raw(spark, base, "yellow_taxi", "b1") == 5
    assert land_raw(spark, base, "yellow_taxi", "b1") == 0
    landed = read_trips(spark, f"{base}/raw/yellow_taxi/batch=b1")
    rows = {r.a: (r.fare, r.tip, r.extra) for r in landed.collect()}
    assert rows == {
        "1": ("20", "3", None),
        "2": ("30", "4", "x"),
        "3": ("40", "5", None),
        "4": ("50", None, None),
        "5": (None, "6", None),
    }
    places = {r.a: r._landed_from for r in landed.collect()}
    assert places["2"] == "yellow_taxi/other.CSV" and places["4"].startswith("yellow_taxi/one/")
    assert land_raw(spark, base, "yellow_taxi", "b2") == 0
    (folder / "late.csv").write_text("a,fare\n6,60\n")
    assert land_raw(spark, base, "yellow_taxi", "b3") == 1


def test_manifest(spark, tmp_path):
    folder = tmp_path / "incoming" / "x"
    (folder / "sub").mkdir(parents=True)
    (folder / "a.PARQUET").write_bytes(b"x" * 1024)
    (folder / "b.txt").write_text("no")
    (folder / "c.csv").write_text("")
    rows = {r.raw_key: (r.valid, r.reason) for r in incoming_manifest(spark, str(tmp_path)).collect()}
    assert rows == {
        "raw/x/a.PARQUET": (True, None),
        "raw/x/b.txt": (False, "unsupported file type"),
        "raw/x/c.csv": (False, "empty file"),
    }


def test_drift_needs_no_scan(spark):
    df = spark.createDataFrame([("1", 2)], "a string, c int")
    expected = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    kinds = {r["column"]: r.kind for r in schema_drift(df, expected).collect()}
    assert kinds == {"a": "retyped", "b": "missing", "c": "extra"}


def trips(spark, rows):
    return standard_trips(
        spark.createDataFrame(
            rows,
            "VendorID string, tpep_pickup_datetime string, tpep_dropoff_datetime string, "
            "passenger_count string, trip_distance string, PULocationID string, "
            "DOLocationID string, fare_amount string, tip_amount string, total_amount string",
        )
    )


ROW = ("1", "2023-11-02 17:00:00", "2023-11-02 17:26:00", "1", "2", "1", "2", "9", "1", "10")


def changed(**values):
    names = "vendor pickup dropoff passengers distance pu do fare tip total".split()
    return tuple(values.get(n, v) for n, v in zip(names, ROW))


def test_valid_and_rejected_share_nothing(spark):
    rows = [
        ROW,
        changed(passengers=None),
        changed(vendor=None),
        changed(vendor="x"),
        changed(fare=None),
        changed(fare="-1"),
        changed(pickup="junk"),
        changed(dropoff="2023-11-02 17:00:00"),
        changed(passengers="-2", fare="-3"),
        changed(pu=None, do=None),
    ]
    df = trips(spark, rows)
    valid, rejected = split_valid(df)
    assert (valid.count(), rejected.count()) == (2, 8)
    reasons = [tuple(r.reject_reason) for r in rejected.filter("passenger_count = -2").collect()]
    assert reasons == [("negative fare", "negative passenger_count")]


def test_null_key_is_no_integrity_failure_but_is_listed(spark):
    df = trips(spark, [ROW, changed(vendor=None), changed(vendor="7")])
    zones = spark.createDataFrame([(1,), (2,)], "location_id int")
    vendors = spark.createDataFrame([(1,)], "vendor_id int")
    counts = quality.rule_counts(df, zones, vendors).first()
    assert (counts.R01, counts.R05, counts.R06, counts.R07) == (1, 1, 0, 0)
    assert quality.missing_in_master(df, "vendor_id", vendors, "vendor_id").count() == 2


def test_absent_master_passes(spark):
    df = trips(spark, [ROW])
    none = spark.createDataFrame([], "vendor_id int")
    results = {
        r.rule_id: r for r in quality.dq_results(df, None, none, "r", "2024-01-01T00:00:00").collect()
    }
    assert results["R05"].description == "vendor_id in master (no master)"
    assert all(r.status == "PASS" for r in results.values())


def test_empty_trips_fail_the_row_count_only(spark):
    results = quality.dq_results(trips(spark, []), None, None, "r", "2024-01-01T00:00:00").collect()
    assert [r.rule_id for r in results if r.status == "FAIL"] == ["R09"]
    with pytest.raises(quality.QualityGateError):
        quality.dq_gate(quality.dq_run_summary(spark.createDataFrame(results)))


def test_first_value_per_attribute(spark):
    rows = [(1, 2, None, "b", "s"), (1, 1, None, None, "t"), (1, 3, "q", "c", None), (2, 1, None, None, None)]
    df = spark.createDataFrame(rows, "location_id int, n int, borough string, zone_name string, service_zone string")
    got = {r.location_id: r[1:] for r in dim_zone(df, [F.col("n")]).collect()}
    assert got == {1: ("q", "b", "t"), 2: (None, None, None)}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_take_one_scan_and_no_window(spark, tmp_path):
    trips(spark, [ROW] * 3).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    counts = quality.rule_counts(df, None, None)
    assert plan_of(counts).count("FileScan") == 1
    assert counts.first().R08 == 2


def test_copies_are_cut_down_before_the_shuffle(spark, tmp_path):
    trips(spark, [ROW] * 3).write.parquet(str(tmp_path / "t"))
    plan = plan_of(dedup_trips(spark.read.parquet(str(tmp_path / "t"))))
    assert plan.count("WindowGroupLimit") == 2


def test_broadcast_only_below_the_bounds(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))

    def hinted(**bounds):
        for name, value in bounds.items():
            monkeypatch.setattr(runtime, name, value)
        return "ResolvedHint" in runtime.broadcast_if_small(df, 999)._jdf.queryExecution().analyzed().toString()

    assert hinted()
    assert not hinted(TINY_BYTES=1)
    assert not hinted(CHECK_BYTES=1)


def test_alarms_and_missing_data(spark):
    at = dt.datetime(2024, 1, 1, 0, 1)
    rows = [
        ("AWS/ApiGateway", "4XXError", at, 6.0),
        ("AWS/ApiGateway", "4XXError", at + dt.timedelta(minutes=3), 4.0),
        ("DataQuality", "QualityScore", at, 0.96),
        ("DataQuality", "QualityScore", at, 0.94),
        ("DataQuality", "RejectedRows", at, 100.0),
    ]
    df = spark.createDataFrame(rows, "namespace string, metric string, ts timestamp_ntz, value double")
    states = {r.name: r.state for r in monitoring.alarm_status(df).collect()}
    assert {n for n, s in states.items() if s == "ALARM"} == {"api-4xx", "dq-score-low"}
    assert len(states) == 8


def test_every_statistic_and_comparison(spark):
    at = dt.datetime(2024, 1, 1, 0, 1)
    df = spark.createDataFrame(
        [("n", "m", at, 2.0), ("n", "m", at, 4.0)],
        "namespace string, metric string, ts timestamp_ntz, value double",
    )

    def state(statistic, comparison, limit):
        alarm = spark.createDataFrame(
            [("x", "n", "m", statistic, comparison, limit)],
            "name string, namespace string, metric string, statistic string, comparison string, "
            "threshold double",
        )
        row = monitoring.metric_alarms(df, alarm).first()
        return row.value, row.state

    assert state("Average", "<=", 3.0) == (3.0, "ALARM")
    assert state("SampleCount", ">", 2.0) == (2.0, "OK")
    for bad in (("Median", ">", 1.0), ("Sum", "!=", 1.0)):
        with pytest.raises(Exception, match="unknown"):
            state(*bad)


def test_alert_lines(spark):
    df = spark.createDataFrame(
        [("autumn-17", "SUCCEEDED", 0.875, 41, None), (None, "STOPPED", None, None, "disk is full")],
        "run_id string, status string, quality_score double, rejected_rows long, error string",
    )
    ok, bad = [r.message.split("\n") for r in monitoring.alert_rows(df).collect()]
    assert ok[0] == "[OK] tripmart pipeline: SUCCEEDED"
    assert "run_id: autumn-17" in ok and "quality_score: 0.875" in ok and "rejected_rows: 41" in ok
    assert bad[0] == "[ALERT] tripmart pipeline: STOPPED"
    assert bad[2:4] == ["run_id: n/a", "error: disk is full"]
