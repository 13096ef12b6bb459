"""As-of joins against a look at every version, and keys that later loads leave alone."""

import random
from datetime import datetime, timedelta

import pytest

from tripmart.operators.scd2 import continue_surrogate_keys, scd2_initial, scd2_merge
from tripmart.operators.versions import join_versions

DAY = datetime(2024, 1, 1)
HISTORY = "natural_key int, valid_from timestamp_ntz, valid_to timestamp_ntz, name string, y int"
ROWS = "id int, k int, at timestamp_ntz, _row string, name string"


@pytest.fixture
def many_ranges(spark):
    """As many ranges as there are shuffle partitions, whatever their size."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def cases(seed):
    rng = random.Random(seed)
    history = []
    for key in (1, 2, 3, None):
        at = DAY
        # Key 1 has nearly all versions.
        for n in range(120 if key == 1 else 3):
            end = at + timedelta(hours=rng.randrange(0, 5))
            if n % 7 == 3:
                end = at  # valid at no time
            history.append((key, at, end, f"{key}-{n}", n))
            at = end + timedelta(hours=rng.choice([0, 0, 2]))  # some gaps
    rows = [
        (i, rng.choice([1, 1, 1, 2, 3, 4, None]),
         rng.choice([None, DAY + timedelta(minutes=30 * rng.randrange(-20, 700))]), "r", "own")
        for i in range(400)
    ]
    return history, rows + rows[:3]


@pytest.mark.parametrize("seed", [1, 2])
def test_like_a_look_at_every_version(spark, many_ranges, seed):
    history, rows = cases(seed)
    got = join_versions(
        spark.createDataFrame(rows, ROWS), spark.createDataFrame(history, HISTORY),
        "k", "at", ("name", "y"), prefix="v_",
    )
    assert got.columns == ["id", "k", "at", "_row", "name", "v_name", "v_y"]
    want = []
    for row in rows:
        _, key, at, *_ = row
        valid = [
            h[3:] for h in history
            if None not in (key, at) and h[0] == key and h[1] <= at < h[2]
        ]
        want.append((*row, *(valid[-1] if valid else (None, None))))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_without_versions_or_rows(spark):
    history, rows = cases(3)
    none, some = spark.createDataFrame([], HISTORY), spark.createDataFrame(rows, ROWS)
    assert {r.y for r in join_versions(some, none, "k", "at", ("y",)).collect()} == {None}
    empty = spark.createDataFrame([], ROWS)
    assert join_versions(empty, spark.createDataFrame(history, HISTORY), "k", "at", ("y",)).isEmpty()


def test_keys_stay(spark):
    """A load with keys before and between the old ones leaves their numbers."""
    rows = lambda names: spark.createDataFrame(list(names.items()), "id int, name string")
    first = scd2_initial(rows({10: "a", 20: "b", 30: None}), "id", ("name",), "2024-01-01 00:00:00")
    one = continue_surrogate_keys(first, None, ("name",))
    merged = scd2_merge(rows({5: "z", 10: "a", 20: "new", 25: "y"}), one, "id", ("name",), "2024-02-01 00:00:00")
    two = continue_surrogate_keys(merged, one, ("name",))
    old = {(r.natural_key, str(r.valid_from)): r.surrogate_key for r in one.collect()}
    new = {(r.natural_key, str(r.valid_from)): r.surrogate_key for r in two.collect()}
    assert old.items() <= new.items() and sorted(new.values()) == list(range(1, 7))
    assert [k for k, v in sorted(new.items(), key=lambda x: x[1])][3:] == [
        (k, "2024-02-01 00:00:00") for k in (5, 20, 25)
    ]
    again = continue_surrogate_keys(merged, two, ("name",))
    assert sorted(map(str, again.collect())) == sorted(map(str, two.collect()))
