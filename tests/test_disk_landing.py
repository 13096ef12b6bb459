"""Landed csv and json lie compressed, and every reader of the raw zone takes them."""

import gzip

from pyspark.sql import functions as F

from tripmart.sinks.writers import land_raw
from tripmart.sources.landing import incoming_manifest, lake_inventory
from tripmart.sources.readers import read_trips


def deliver(base):
    folder = base / "incoming/t"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("a,b\n" + "".join(f'{i},"north, {i % 7}"\n' for i in range(3000)))
    (folder / "B.CSV").write_text("b,a\n" + "".join(f"south,{i}\n" for i in range(3000, 4000)))
    (folder / "c.json").write_text("".join(f'{{"a": {i}, "b": "east"}}\n' for i in range(4000, 7000)))
    return folder


def size(folder, pattern="*"):
    return sum(p.stat().st_size for p in folder.rglob(pattern) if p.is_file())


def test_text_is_landed_compressed_and_read_whole(spark, tmp_path):
    folder = deliver(tmp_path)
    assert land_raw(spark, str(tmp_path), "t", "1") == 7000
    assert size(tmp_path / "raw/t", "part-*") < size(folder) / 2
    landed = read_trips(spark, f"{tmp_path}/raw/t")
    rows = {int(r.a): (r.b, r._landed_from) for r in landed.collect()}
    assert len(rows) == landed.count() == 7000
    assert rows[13] == ("north, 6", "t/a.csv")
    assert rows[3500] == ("south", "t/B.CSV") and rows[6999] == ("east", "t/c.json")


def test_the_inventory_counts_landed_text(spark, tmp_path):
    deliver(tmp_path)
    land_raw(spark, str(tmp_path), "t", "1")
    found = {r.zone: r for r in lake_inventory(spark, str(tmp_path)).collect()}
    logged = spark.read.parquet(f"{tmp_path}/raw/_landed/t").count()
    assert found["incoming"].rows == 7000 and found["raw"].rows in (7000, 7000 + logged)
    parts = len([p for p in (tmp_path / "raw/t").rglob("part-*") if p.suffix != ".crc"])
    assert found["raw"].files >= parts


def test_compressed_files_that_were_delivered_stay_refused(spark, tmp_path):
    folder = deliver(tmp_path)
    for name in ("d.csv.gz", "d.json.gz"):
        with gzip.open(folder / name, "wt") as f:
            f.write("a,b\n1,2\n")
    refused = incoming_manifest(spark, str(tmp_path)).where(~F.col("valid"))
    assert {r.reason for r in refused.collect()} == {"unsupported file type"}
    assert land_raw(spark, str(tmp_path), "t", "1") == 7000
    assert read_trips(spark, str(folder)).count() == 7000
