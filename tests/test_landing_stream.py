"""The landing stream: all kinds of files, growing columns, once each."""

import os
import shutil

from pyspark.sql import functions as F

from tripmart.sinks.writers import land_raw
from tripmart.sources.headers import first_line
from tripmart.sources.readers import read_trips
from tripmart.streaming.landing import landing_stream


def put(base, name, text):
    path = base / "incoming" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


def parquet(spark, base, name, rows, columns):
    """One parquet file under a chosen name."""
    folder = f"{base}/made-{name.replace('/', '-')}"
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(folder)
    part = next(n for n in os.listdir(folder) if n.endswith(".parquet"))
    target = base / "incoming" / name
    target.parent.mkdir(parents=True, exist_ok=True)
    shutil.copy(f"{folder}/{part}", target)


def run(spark, base, checkpoint="checkpoint", files=2):
    landing_stream(spark, str(base), f"{base}/{checkpoint}", files).awaitTermination()


def rows(spark, base, source="t"):
    landed = read_trips(spark, f"{base}/raw/{source}")
    found = landed.select("_landed_from", *[F.col(c).cast("string") for c in ("a", "b", "c")])
    return sorted(tuple(r) for r in found.collect())


def deliver(spark, base):
    parquet(spark, base, "t/one.parquet", [("1", "2")], "a string, b string")
    parquet(spark, base, "t/day 2/TWO.PARQUET", [("3", "4", "5")], "a string, b string, c string")
    put(base, "t/three.csv", "a,b\r\n6,7\r\n")
    put(base, "t/FOUR.CSV", "c,b,a\n10,9,8")
    put(base, "t/five.json", '{"a": 11, "c": 12}\n')
    put(base, "u/six.csv", "a,b,c\n13,14,15\n")
    put(base, "t/empty.csv", "")
    put(base, "t/notes.txt", "a,b\n0,0\n")
    put(base, "loose.csv", "a,b\n0,0\n")


WANT = [
    ("t/FOUR.CSV", "8", "9", "10"),
    ("t/day%202/TWO.PARQUET", "3", "4", "5"),
    ("t/five.json", "11", None, "12"),
    ("t/one.parquet", "1", "2", None),
    ("t/three.csv", "6", "7", None),
]


def test_kinds_and_growing_columns(spark, tmp_path):
    deliver(spark, tmp_path)
    run(spark, tmp_path)
    assert rows(spark, tmp_path) == WANT
    assert rows(spark, tmp_path, "u") == [("u/six.csv", "13", "14", "15")]
    put(tmp_path, "t/seven.csv", "b,d\n16,17\n")
    run(spark, tmp_path)
    assert rows(spark, tmp_path) == sorted([*WANT, ("t/seven.csv", None, "16", None)])
    assert read_trips(spark, f"{tmp_path}/raw/t").filter("d = '17'").count() == 1


def test_nothing_is_lost_or_repeated(spark, tmp_path):
    """Lost commits, a broken batch, a lost checkpoint and another way of landing."""
    deliver(spark, tmp_path)
    run(spark, tmp_path)
    commits = tmp_path / "checkpoint/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if (commits / name).exists():
            (commits / name).unlink()
    # Of the last batch, also the note that it was landed is lost.
    for log in (tmp_path / "raw/_landed").iterdir():
        for part in log.glob("*.parquet"):
            batches = {r.batch for r in spark.read.parquet(str(part)).select("batch").collect()}
            if any(b.endswith(f"-{last:08d}") for b in batches):
                part.unlink()
                (log / f".{part.name}.crc").unlink(missing_ok=True)
    run(spark, tmp_path)
    assert rows(spark, tmp_path) == WANT
    run(spark, tmp_path, "another")
    assert land_raw(spark, str(tmp_path), "t", "b1") == 0
    assert rows(spark, tmp_path) == WANT


def test_a_batch_is_one_file_of_the_log(spark, tmp_path):
    """However many files it lands: all later batches read the log."""
    put(tmp_path, "t/0.csv", "a,b\n0,0\n")
    run(spark, tmp_path, files=20)
    for i in range(1, 9):
        put(tmp_path, f"t/{i}.csv", f"a,b\n{i},{i}\n")
    run(spark, tmp_path, files=20)
    log = tmp_path / "raw/_landed/t"
    assert spark.read.parquet(str(log)).count() == 9
    assert len(list(log.glob("part-*"))) == 2


def test_first_lines(tmp_path):
    for text, line in {"": "", "a": "a", "a,b\r\n1": "a,b", "x" * 70_000 + "\ny": "x" * 70_000}.items():
        (tmp_path / "f").write_bytes(text.encode())
        assert first_line(f"file:{tmp_path}/f") == line
