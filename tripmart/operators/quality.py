"""Data-quality rules, scores, gate, listings and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.operators.facts import dedup_trips
from tripmart.operators.key_index import key_digest
from tripmart.runtime import broadcast_if_small

MASTER_RULES = (
    ("R05", "vendor_id", "vendor_id"),
    ("R06", "pu_location_id", "location_id"),
    ("R07", "do_location_id", "location_id"),
)


class QualityGateError(RuntimeError):
    """The quality score of a run is below the threshold."""


def _any_null() -> Column:
    cond = F.lit(False)
    for c in schemas.REQUIRED:
        cond = cond | F.col(c).isNull()
    return cond


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def _row_flags() -> dict[str, Column]:
    """0/1 per rule that looks at one row only."""
    return {
        "R01": _flag(_any_null()),
        "R02": _flag(F.col("dropoff_datetime") <= F.col("pickup_datetime")),
        "R03": _flag(F.col("fare_amount") < 0),
        "R04": _flag(F.coalesce(F.col("passenger_count"), F.lit(0)) < 0),
    }


def _with_membership(df: DataFrame, rule: str, key: str, master: DataFrame | None, master_key: str):
    """Add a column that says whether the key is in the master."""
    if master is None:
        return df.withColumn(f"_{rule}", F.lit(None).cast("boolean"))
    keys = (
        master.filter(F.col(master_key).isNotNull())
        .select(F.col(master_key).alias(key))
        .distinct()
        .withColumn(f"_{rule}", F.lit(True))
    )
    return df.join(broadcast_if_small(keys), key, "left")


def rule_counts(
    trips: DataFrame,
    zones: DataFrame | None,
    vendors: DataFrame | None,
    elsewhere: DataFrame | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """One row: rows in total and failed rows of R01 to R08.

    A single scan and a single shuffle of the trips: rows are first aggregated
    by natural key, where duplicates show, and carry their other flags along as
    sums. Membership depends on the key alone, so it is looked up after that.
    An absent or empty master fails no row; a NULL key is left to R01. With
    ``elsewhere`` (digests of keys that other batches have brought) every row of such
    a key is a duplicate, not just the second. With ``keys`` (as ``key_index.batch_keys``
    counts them in the index of these trips) the trips are not shuffled at all.
    """
    if keys is not None:
        return _counts_by_index(trips, zones, vendors, keys)
    flags = _row_flags()
    groups = trips.groupBy(*schemas.TRIP_KEY).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(cond).alias(rule) for rule, cond in flags.items()],
    )
    masters = {"R05": vendors, "R06": zones, "R07": zones}
    sums = [F.coalesce(F.sum(rule), F.lit(0)).alias(rule) for rule in flags]
    for rule, key, master_key in MASTER_RULES:
        groups = _with_membership(groups, rule, key, masters[rule], master_key)
        outside = F.col(key).isNotNull() & F.col(f"_{rule}").isNull()
        sums.append(F.coalesce(F.sum(F.when(outside, F.col("_n"))), F.lit(0)).alias(rule))
    repeated = F.col("_n") - 1
    if elsewhere is not None:
        known = elsewhere.select(F.col("digest").alias("_digest"), F.lit(1).alias("_known"))
        groups = groups.withColumn("_digest", key_digest()).join(known, "_digest", "left")
        repeated = repeated + F.coalesce("_known", F.lit(0))
    sums.append(F.coalesce(F.sum(repeated), F.lit(0)).alias("R08"))
    return groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), *sums)


def _counts_by_index(
    trips: DataFrame, zones: DataFrame | None, vendors: DataFrame | None, keys: DataFrame
) -> DataFrame:
    """:func:`rule_counts` of trips whose keys the index has counted."""
    flags = _row_flags()
    masters = {"R05": vendors, "R06": zones, "R07": zones}
    sums = [F.coalesce(F.sum(cond), F.lit(0)).alias(rule) for rule, cond in flags.items()]
    for rule, key, master_key in MASTER_RULES:
        trips = _with_membership(trips, rule, key, masters[rule], master_key)
        outside = F.col(key).isNotNull() & F.col(f"_{rule}").isNull()
        sums.append(F.count_if(outside).alias(rule))
    rows = trips.agg(F.count(F.lit(1)).alias("total_rows"), *sums)
    return rows.crossJoin(F.broadcast(keys)).select(  # one row each
        *rows.columns, (F.col("total_rows") - F.col("keys") + F.col("elsewhere")).alias("R08")
    )


def dq_results(
    trips: DataFrame,
    zones: DataFrame | None,
    vendors: DataFrame | None,
    run_id: str,
    run_ts: str,
    min_rows: int = schemas.DQ_MIN_ROWS,
    elsewhere: DataFrame | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """One row per rule of a run; ``elsewhere`` and ``keys`` as :func:`rule_counts` takes them."""
    zones = zones if zones is not None and not zones.isEmpty() else None
    vendors = vendors if vendors is not None and not vendors.isEmpty() else None
    absent = {"R05": vendors is None, "R06": zones is None, "R07": zones is None}
    counts = rule_counts(trips, zones, vendors, elsewhere, keys).withColumn(
        "R09", F.when(F.col("total_rows") >= min_rows, 0).otherwise(1)
    )
    rules = [
        F.struct(
            F.lit(rule).alias("rule_id"),
            F.lit(
                text.format(min_rows=min_rows) + (" (no master)" if absent.get(rule) else "")
            ).alias("description"),
            F.lit(0).cast("bigint").alias("failed_rows")
            if absent.get(rule)
            else F.col(rule).cast("bigint").alias("failed_rows"),
        )
        for rule, text in schemas.DQ_RULES
    ]
    passed = sum(
        (F.lit(1) if absent.get(rule) else _flag(F.col(rule) == 0) for rule, _ in schemas.DQ_RULES),
        F.lit(0),
    )
    score = F.round(passed.cast("decimal(9,0)") / F.lit(len(rules)).cast("decimal(9,0)"), 4)
    return counts.select(
        score.cast("decimal(5,4)").alias("quality_score"),
        "total_rows",
        F.inline(F.array(*rules)),
    ).select(
        "rule_id",
        "description",
        "failed_rows",
        F.when(F.col("failed_rows") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.lit(run_id).alias("run_id"),
        F.lit(run_ts).alias("run_ts"),
        "quality_score",
        "total_rows",
    )


def dq_run_summary(results: DataFrame, threshold: float = schemas.DQ_THRESHOLD) -> DataFrame:
    """One row per run in ``results``."""
    return (
        results.groupBy("run_id", "run_ts", "quality_score", "total_rows")
        .agg(
            F.sum("failed_rows").alias("rejected_rows"),
            F.count_if(F.col("status") == "FAIL").alias("failed_rule_count"),
        )
        .withColumn(
            "status",
            F.when(F.col("quality_score") >= F.lit(threshold), "PASS").otherwise("FAIL"),
        )
    )


def dq_gate(summary: DataFrame) -> None:
    """Raise unless the run passed; ``summary`` has one row."""
    row = summary.select("run_id", "quality_score", "status").first()
    if row is None or row.status != "PASS":
        score = "none" if row is None else row.quality_score
        raise QualityGateError(f"quality gate failed: score {score}")


def dq_metrics(summary: DataFrame, namespace: str = "DataQuality") -> DataFrame:
    """Three metrics per run in long form."""
    return summary.select(
        F.lit(namespace).alias("namespace"),
        F.col("run_ts").cast("timestamp_ntz").alias("ts"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(metric).alias("metric"),
                        F.col(source).cast("decimal(20,4)").alias("value"),
                    )
                    for metric, source in (
                        ("QualityScore", "quality_score"),
                        ("RejectedRows", "rejected_rows"),
                        ("FailedRuleCount", "failed_rule_count"),
                    )
                ]
            )
        ),
    )


# --- listings: zero rows mean that the rule holds -------------------------------


def required_violations(trips: DataFrame) -> DataFrame:
    return trips.filter(_any_null()).select(
        F.lit("R01_required_fields").alias("rule_id"),
        "trip_id",
        F.lit("null required column").alias("failure_reason"),
    )


def datetime_violations(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col("dropoff_datetime") <= F.col("pickup_datetime")).select(
        F.lit("R02_datetime_validity").alias("rule_id"),
        "trip_id",
        "pickup_datetime",
        "dropoff_datetime",
        F.lit("dropoff not after pickup").alias("failure_reason"),
    )


def fare_violations(trips: DataFrame) -> DataFrame:
    """Negative fares, and negative passenger counts of the others."""
    reason = F.when(F.col("fare_amount") < 0, "negative fare").when(
        F.col("passenger_count") < 0, "negative passenger_count"
    )
    return trips.select(
        F.lit("R03_fare_validity").alias("rule_id"),
        "trip_id",
        "fare_amount",
        "passenger_count",
        reason.alias("failure_reason"),
    ).filter("failure_reason IS NOT NULL")


def passenger_violations(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col("passenger_count") < 0).select(
        F.lit("R04_passenger_count").alias("rule_id"),
        "trip_id",
        "passenger_count",
        F.lit("negative passenger_count").alias("failure_reason"),
    )


def missing_in_master(trips: DataFrame, key: str, master: DataFrame, master_key: str) -> DataFrame:
    """Trips whose key the master lacks; unlike in the rules, NULL counts as lacking."""
    keys = master.select(F.col(master_key).alias(key)).distinct()
    return trips.join(broadcast_if_small(keys), key, "left_anti")


def integrity_violations(trips: DataFrame, zones: DataFrame, vendors: DataFrame) -> DataFrame:
    """All three references in one listing, from one scan of the trips."""
    masters = {"R05": vendors, "R06": zones, "R07": zones}
    texts = {
        "R05": "vendor_id not in master",
        "R06": "pickup_location_id not in master",
        "R07": "dropoff_location_id not in master",
    }
    for rule, key, master_key in MASTER_RULES:
        trips = _with_membership(trips, rule, key, masters[rule], master_key)
    reasons = F.array(*[F.when(F.col(f"_{r}").isNull(), F.lit(t)) for r, t in texts.items()])
    return trips.select(
        F.lit("R04_referential_integrity").alias("rule_id"),
        "trip_id",
        F.explode(F.filter(reasons, lambda r: r.isNotNull())).alias("failure_reason"),
    )


def union_integrity_violations(
    trips: DataFrame, zones: DataFrame, vendors: DataFrame
) -> DataFrame:
    """The same listing as union of three anti joins."""
    parts = [
        missing_in_master(trips, key, master, master_key).select(
            F.lit("R04_referential_integrity").alias("rule_id"),
            "trip_id",
            F.lit(text).alias("failure_reason"),
        )
        for key, master, master_key, text in (
            ("vendor_id", vendors, "vendor_id", "vendor_id not in master"),
            ("pu_location_id", zones, "location_id", "pickup_location_id not in master"),
            ("do_location_id", zones, "location_id", "dropoff_location_id not in master"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def duplicate_keys(trips: DataFrame) -> DataFrame:
    """Natural keys that occur more than once, with the number of occurrences."""
    return (
        trips.groupBy(*schemas.TRIP_KEY)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter("occurrences > 1")
    )


def duplicate_violations(trips: DataFrame) -> DataFrame:
    return duplicate_keys(trips).select(
        F.lit("R05_duplicate_detection").alias("rule_id"),
        *schemas.TRIP_KEY,
        "occurrences",
        F.lit("duplicate natural key").alias("failure_reason"),
    )


def duplicate_groups(trips: DataFrame) -> DataFrame:
    return duplicate_keys(trips).agg(F.count(F.lit(1)).alias("duplicate_groups"))


def duplicate_excess(trips: DataFrame) -> DataFrame:
    return duplicate_keys(trips).agg(
        F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).alias("duplicate_rows")
    )


def row_count_check(trips: DataFrame, min_rows: int = schemas.DQ_MIN_ROWS) -> DataFrame:
    return trips.agg(
        F.when(F.count(F.lit(1)) >= min_rows, "PASS").otherwise("FAIL").alias("row_count_check"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def null_profile(trips: DataFrame) -> DataFrame:
    """NULLs per profiled column."""
    names = {
        "vendor_id": "null_vendor_id",
        "pickup_datetime": "null_pickup",
        "dropoff_datetime": "null_dropoff",
        "fare_amount": "null_fare",
        "passenger_count": "null_passengers",
    }
    return trips.agg(*[F.count_if(F.col(c).isNull()).alias(n) for c, n in names.items()])


def dq_violations(trips: DataFrame, zones: DataFrame, vendors: DataFrame) -> DataFrame:
    """Violations of all row rules and of R08, one row per trip and rule.

    For R08 the excess copies are listed: per natural key, occurrences minus one.
    """
    marked = trips
    masters = {"R05": vendors, "R06": zones, "R07": zones}
    for rule, key, master_key in MASTER_RULES:
        marked = _with_membership(marked, rule, key, masters[rule], master_key)
    failed = [F.when(flag == 1, F.lit(rule)) for rule, flag in _row_flags().items()]
    failed += [
        F.when(F.col(key).isNotNull() & F.col(f"_{rule}").isNull(), F.lit(rule))
        for rule, key, _ in MASTER_RULES
    ]
    rows = marked.select(
        F.explode(F.filter(F.array(*failed), lambda r: r.isNotNull())).alias("rule_id"),
        *schemas.TRIP_KEY,
        F.lit(1).cast("bigint").alias("failed_rows"),
    )
    copies = duplicate_keys(trips).select(
        F.lit("R08").alias("rule_id"),
        *schemas.TRIP_KEY,
        (F.col("occurrences") - 1).alias("failed_rows"),
    )
    return rows.unionByName(copies)


def dq_route(
    trips: DataFrame, zones: DataFrame, vendors: DataFrame
) -> dict[str, DataFrame]:
    """Trips by what their worst rule asks for: reject, quarantine, warn or accept.

    Auto-fix comes first: negative passenger counts become the default 1 and of
    several copies of a trip one is kept. Reject outranks quarantine, which
    outranks warn; warned and accepted trips go on, the others are set aside.
    """
    actions = {rule: action for rule, _, action in schemas.DQ_ACTIONS}
    fixed = dedup_trips(
        trips.withColumn(
            "passenger_count",
            F.when(F.col("passenger_count") < 0, 1).otherwise(F.col("passenger_count")),
        )
    )
    masters = {"R05": vendors, "R06": zones, "R07": zones}
    failed = {
        rule: flag == 1
        for rule, flag in _row_flags().items()
        if actions[rule] != "auto-fix"
    }
    for rule, key, master_key in MASTER_RULES:
        fixed = _with_membership(fixed, rule, key, masters[rule], master_key)
        failed[rule] = F.col(key).isNotNull() & F.col(f"_{rule}").isNull()
    route = F.lit("accept")
    for action in ("warn", "quarantine", "reject"):
        for rule, cond in failed.items():
            if actions[rule] == action:
                route = F.when(cond, action).otherwise(route)
    routed = fixed.withColumn("route", route).drop(*[f"_{r}" for r, _, _ in MASTER_RULES])
    return {
        name: routed.filter(F.col("route") == name)
        for name in ("reject", "quarantine", "warn", "accept")
    } | {"all": routed}


# --- reports over stored results ----------------------------------------------------


def latest_failed_rules(results: DataFrame) -> DataFrame:
    """Rule results of the newest run, most failed rows first."""
    newest = results.agg(F.max("run_id").alias("run_id"))
    return (
        results.join(F.broadcast(newest), "run_id")
        .select("rule_id", "description", "status", "failed_rows")
        .orderBy(F.desc("failed_rows"), "rule_id")
    )


def latest_runs(summary: DataFrame, n: int = 1) -> DataFrame:
    return summary.orderBy(F.desc("run_ts"), F.desc("run_id")).limit(n)


def quality_trend(summary: DataFrame) -> DataFrame:
    return summary.select(
        "run_ts",
        "quality_score",
        "rejected_rows",
        (F.col("quality_score") * 100).alias("quality_pct"),
        _flag(F.col("status") == "FAIL").alias("is_fail"),
    ).orderBy("run_ts")
