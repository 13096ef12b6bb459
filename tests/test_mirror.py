"""The mirror of landed files: same bytes, same places, never overwritten."""

import hashlib
import os

import pytest

from tripmart.sinks import mirror
from tripmart.sinks.mirror import copy_file, mirror_log, mirror_raw


def put(base, name, data, zone="incoming"):
    path = base / zone / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    return path


def statuses(df):
    return {r.raw_key: r.status for r in df.collect()}


def test_bytes_and_places(spark, tmp_path):
    data = {"trips/day 1/a.CSV": b"a,b\r\n1,2", "zones/z.json": b"{}", "trips/p.parquet": os.urandom(9000)}
    for name, content in data.items():
        put(tmp_path, name, content)
    put(tmp_path, "trips/readme.txt", b"no")
    put(tmp_path, "trips/empty.csv", b"")
    log = mirror_raw(spark, str(tmp_path), "b1")
    assert statuses(log) == {f"raw/{name}": "copied" for name in data}
    for r in log.collect():
        content = data[r.raw_key.removeprefix("raw/")]
        assert (tmp_path / r.raw_key).read_bytes() == content
        assert (r.sha256, r.length) == (hashlib.sha256(content).hexdigest(), len(content))
    assert not (tmp_path / "raw/trips/readme.txt").exists()
    assert mirror_raw(spark, str(tmp_path), "b2").isEmpty()
    assert statuses(mirror_raw(spark, str(tmp_path), "b1")) == statuses(log)


def test_a_name_is_never_written_again(spark, tmp_path):
    put(tmp_path, "t/a.csv", b"one")
    put(tmp_path, "t/b.csv", b"one")
    mirror_raw(spark, str(tmp_path), "b1")
    os.utime(put(tmp_path, "t/a.csv", b"two"), (5, 5))  # other bytes, same length
    os.utime(put(tmp_path, "t/b.csv", b"one"), (5, 5))  # delivered again
    put(tmp_path, "t/c.csv", b"new")
    want = {"raw/t/a.csv": "refused", "raw/t/b.csv": "present", "raw/t/c.csv": "copied"}
    assert statuses(mirror_raw(spark, str(tmp_path), "b2")) == want
    assert (tmp_path / "raw/t/a.csv").read_bytes() == b"one"
    assert statuses(mirror_raw(spark, str(tmp_path), "b3")) == {"raw/t/a.csv": "refused"}


def test_a_batch_that_broke_off(spark, tmp_path):
    """Copies without a log are found present; a part is left out of the way."""
    put(tmp_path, "t/a.csv", b"one")
    put(tmp_path, "t/a.csv", b"one", "raw")
    put(tmp_path, "t/.a.csv.part", b"on", "raw")
    assert statuses(mirror_raw(spark, str(tmp_path), "b1")) == {"raw/t/a.csv": "present"}
    assert mirror_log(spark, str(tmp_path)).count() == 1


def test_a_copy_that_fails_leaves_no_name(tmp_path, monkeypatch):
    source = put(tmp_path, "t/a.csv", b"x" * 100)

    def broken(files, path, out=None):
        out.write(b"x" * 10)
        raise OSError("lost")

    monkeypatch.setattr(mirror, "_digest", broken)
    with pytest.raises(OSError, match="lost"):
        copy_file(f"file:{source}", f"file:{tmp_path}/raw/t/a.csv")
    assert not (tmp_path / "raw/t/a.csv").exists()


def test_two_writers(tmp_path, monkeypatch):
    """The slower of two writers finds the name taken."""
    source = put(tmp_path, "t/a.csv", b"late")
    digest = mirror._digest

    def slow(files, path, out=None):
        if out is not None:
            put(tmp_path, "raw/t/a.csv", b"first", "")
        return digest(files, path, out)

    monkeypatch.setattr(mirror, "_digest", slow)
    assert copy_file(f"file:{source}", f"file:{tmp_path}/raw/t/a.csv")[1] == "refused"
    assert [f for f in os.listdir(tmp_path / "raw/t")] == ["a.csv"]
