"""Bucketed histories: loads write what they touch. Old versions go, leased ones stay."""

import os

import pytest
from pyspark.sql import functions as F

from tripmart.sinks import key_buckets
from tripmart.sinks.key_buckets import current_state, publish_changes
from tripmart.sinks.snapshots import (
    PublishConflict,
    current_marker,
    drop_old_versions,
    leased_snapshot,
    publish_snapshot,
    read_snapshot,
    snapshot_folders,
)
from tripmart.streaming.scd2 import merge_changes

SCHEMA = "key int, name string"


def load(spark, dest, rows, number, buckets=16):
    batch = spark.createDataFrame(rows, SCHEMA)
    state = current_state(spark, dest, buckets)
    now = f"2024-01-{number:02d} 00:00:00"
    merged = merge_changes(
        batch, state.versions_of(batch, "key"), "key", ("name",), now, [F.col("name")]
    )
    return publish_changes(merged, state, f"load {number}")


def files(dest):
    return {
        os.path.join(folder, name)
        for folder, _, names in os.walk(dest)
        for name in names
        if name.endswith(".parquet")
    }


def content(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_a_small_load_writes_its_bucket_only(spark, tmp_path):
    dest = str(tmp_path / "h")
    load(spark, dest, [(k, "a") for k in range(4000)], 1)
    before, first = files(dest), current_marker(spark, dest)["layout"]["current"]
    assert len(first) == 16
    load(spark, dest, [(7, "b")], 2)
    second = current_marker(spark, dest)["layout"]["current"]
    assert sum(first[b] != second[b] for b in first) == 1
    added = sum(os.path.getsize(f) for f in files(dest) - before)
    assert added < sum(os.path.getsize(f) for f in before) / 4
    rows = read_snapshot(spark, dest)
    assert rows.count() == 4001 and rows.filter("is_current").count() == 4000
    assert [r.name for r in rows.filter("natural_key = 7").orderBy("valid_from").collect()] == ["a", "b"]
    assert read_snapshot(spark, dest, 1).count() == 4000


def test_loads_equal_one_whole_history(spark, tmp_path, monkeypatch):
    """Null keys, empty loads, a plain snapshot before, and levels of closed folders."""
    monkeypatch.setattr(key_buckets, "MERGED", 2)
    dest, whole = str(tmp_path / "h"), None
    loads = [
        [(k % 5, f"v{n}") for k in range(n, n + 3)] + ([(None, f"n{n}")] if n % 2 else [])
        for n in range(1, 7)
    ]
    loads.insert(3, [])
    for number, rows in enumerate(loads, 1):
        batch = spark.createDataFrame(rows, SCHEMA)
        now = f"2024-01-{number:02d} 00:00:00"
        whole = merge_changes(batch, whole, "key", ("name",), now, [F.col("name")])
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        if number == 1:
            publish_snapshot(whole, dest, partition_by=("is_current",))
        else:
            load(spark, dest, rows, number, buckets=3)
        assert content(read_snapshot(spark, dest)) == content(whole)
    levels = [level for level, _ in current_marker(spark, dest)["layout"]["closed"]]
    assert max(levels) >= 2 and len(levels) == len(set(levels))


def test_an_empty_first_load_and_a_conflict(spark, tmp_path):
    dest = str(tmp_path / "h")
    load(spark, dest, [], 1)
    assert read_snapshot(spark, dest).count() == 0
    stale = current_state(spark, dest)
    load(spark, dest, [(1, "a")], 2)
    late = spark.createDataFrame([(2, "b")], SCHEMA)
    merged = merge_changes(
        late, stale.versions_of(late, "key"), "key", ("name",), "2024-01-03 00:00:00", [F.col("name")]
    )
    with pytest.raises(PublishConflict):
        publish_changes(merged, stale, "late")
    assert [r.name for r in read_snapshot(spark, dest).collect()] == ["a"]


def test_old_versions_go_but_for_leased_ones(spark, tmp_path):
    dest = str(tmp_path / "h")
    load(spark, dest, [(k, "a") for k in range(100)], 1)
    for number in range(2, 6):
        load(spark, dest, [(number, f"b{number}")], number)
    newest = content(read_snapshot(spark, dest))
    with leased_snapshot(spark, dest, version=2) as leased:
        assert drop_old_versions(spark, dest, keep=2) == [1, 3]
        assert leased.count() == 101
    with pytest.raises(FileNotFoundError), leased_snapshot(spark, dest, version=1):
        pass
    assert drop_old_versions(spark, dest, keep=2) == [2]
    assert drop_old_versions(spark, dest, keep=2) == []
    assert content(read_snapshot(spark, dest)) == newest
    assert read_snapshot(spark, dest, 4).count() == 103
    assert drop_old_versions(spark, dest, keep=1) == [4]
    assert content(read_snapshot(spark, dest)) == newest
    named = snapshot_folders(spark, dest)
    assert all(any(f"/{folder}/" in name for folder in named) for name in files(dest))
    with pytest.raises(ValueError):
        drop_old_versions(spark, dest, keep=0)


def test_a_lease_that_ran_out_protects_nothing(spark, tmp_path):
    dest = str(tmp_path / "h")
    rows = spark.createDataFrame([(1, True)], "id int, is_current boolean")
    publish_snapshot(rows, dest)
    publish_snapshot(rows, dest)
    with leased_snapshot(spark, dest, seconds=-1, version=1):
        assert drop_old_versions(spark, dest, keep=1) == [1]
    assert read_snapshot(spark, dest).count() == 1


def test_a_removal_that_broke_off_is_ended(spark, tmp_path):
    dest = tmp_path / "h"
    rows = spark.createDataFrame([(1, True)], "id int, is_current boolean")
    publish_snapshot(rows, str(dest))
    publish_snapshot(rows, str(dest))
    (dest / "_retired").mkdir()
    os.rename(dest / "_published/00000001", dest / "_retired/00000001")
    assert drop_old_versions(spark, str(dest), keep=5) == [1]
    assert len([n for n in os.listdir(dest) if n.startswith("v=")]) == 1
