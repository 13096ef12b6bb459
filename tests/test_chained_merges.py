"""Merges in order against the same, one after the other in Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.operators.chained_merges import _aimed, merge_in_order
from tripmart.schemas import VENDORS

from .test_matching import brute_score

NOW = "2024-03-01 00:00:00"
MASTER = (
    "vendor_pk long, vendor_id int, vendor_name string, vendor_code string, "
    "tech_provider string, contact_email string, source_system string, updated_at timestamp_ntz"
)
ORDERS = "at long, survivor_id long, duplicate_ids array<long>"


def one_by_one(rows, orders, now):
    """The master and what became of each instruction."""
    live, audit = {r["vendor_pk"]: dict(r) for r in rows}, []

    def standing(r):
        trust = schemas.SOURCE_TRUST.get((r["source_system"] or "").lower(), 0)
        return sum(bool(r[a]) for a in VENDORS.attrs), trust, r["updated_at"], -r["vendor_pk"]

    for _, survivor, duplicates in orders:
        if survivor is None or not duplicates:
            audit.append(("survivor_id and duplicate_ids required", 0.0))
            continue
        if survivor not in live:
            audit.append(("survivor not found", 0.0))
            continue
        others = {d for d in duplicates if d in live and d != survivor}
        best = max(
            (brute_score(live[survivor]["vendor_name"] or "", live[d]["vendor_name"] or "") for d in others),
            default=0.0,
        )
        audit.append((None, best))
        ranked = sorted((live[i] for i in others | {survivor}), key=standing, reverse=True)
        golden = {a: next((r[a] for r in ranked if r[a]), None) for a in VENDORS.attrs}
        live[survivor] |= golden
        if now:
            live[survivor]["updated_at"] = dt.datetime.fromisoformat(now)
        for d in others:
            del live[d]
    return live, audit


def records(rng, n):
    def some(values):
        return rng.choice([*values, "", None])

    return [
        {
            "vendor_pk": i,
            "vendor_id": i,
            "vendor_name": some(["Harbour Cabs", "Harbor Cab Co", "Lantern Rides", "Lantern Ride"]),
            "vendor_code": some([f"c{i}"]),
            "tech_provider": some([f"t{i}"]),
            "contact_email": some([f"m{i}"]),
            "source_system": some(["TLC_Registry", "partner_feed", "manual_entry"]),
            "updated_at": dt.datetime(2024, 1, rng.randrange(1, 5)),
        }
        for i in range(n)
    ]


def check(spark, rows, orders, now):
    master = spark.createDataFrame([tuple(r.values()) for r in rows], MASTER)
    merged, audit = merge_in_order(
        master, spark.createDataFrame(orders, ORDERS), VENDORS, "at", now
    )
    assert merged.columns == master.columns
    want, steps = one_by_one(rows, orders, now)
    assert {r.vendor_pk: r.asDict() for r in merged.collect()} == want
    assert merged.count() == len(want)
    got = [(r.refused, float(r.match_score)) for r in audit.orderBy("seq").collect()]
    assert got == [(why, pytest.approx(score, abs=1e-4)) for why, score in steps]


@pytest.mark.parametrize("seed, now", [(1, NOW), (2, None)])
def test_random_orders(spark, seed, now):
    rng = random.Random(seed)
    orders = [
        (at, rng.choice([*range(32), 99, None] if rng.random() < 0.1 else range(30)),
         rng.choice([None, []]) if rng.random() < 0.05 else rng.sample(range(34), rng.randrange(1, 3)))
        for at in range(40)
    ]
    check(spark, records(rng, 30), orders, now)


def test_long_chains(spark):
    """Each survivor is merged on; one survivor is named time after time."""
    rng = random.Random(3)
    chain = [(at, at + 1, [at]) for at in range(20)]
    same = [(20 + at, 21, [22 + at]) for at in range(15)]
    late = [(40, 5, [20]), (41, 21, [20]), (42, 39, [21, 5, 39])]
    check(spark, records(rng, 40), chain + same + late, None)


def test_nothing_to_do(spark):
    rows = records(random.Random(4), 3)
    check(spark, rows, [], NOW)
    check(spark, [], [(1, 1, [2])], NOW)
    numbers = spark.createDataFrame([(1, 2)], "vendor_pk long, vendor_name int").withColumns(
        {a: F.lit(0) for a in VENDORS.attrs}
    )
    with pytest.raises(ValueError):
        merge_in_order(numbers, spark.createDataFrame([], ORDERS), VENDORS, "at")


def test_nothing_grows_in_one_task(spark):
    """No table is broadcast for its small files, and states that lead nowhere spread."""
    rows = [{**r, "vendor_pk": i} for i, r in enumerate(records(random.Random(1), 40))]
    master = spark.createDataFrame(rows, MASTER)
    orders = spark.createDataFrame([(i, i, [i + 1]) for i in range(0, 40, 4)], ORDERS)
    for df in merge_in_order(master, orders, VENDORS, "at", NOW):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    ends = spark.range(50).selectExpr("id AS rec", "0L AS k", "NULL::bigint AS to_rec", "NULL::bigint AS to_k")
    aimed = _aimed(ends)
    assert aimed.select("_at_rec", "_at_k").distinct().count() == 50
    assert aimed.filter("_at_k >= 0").isEmpty()
