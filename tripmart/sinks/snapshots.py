"""Versioned snapshots: replace a table that is also an input of the replacement.

Each version is written to a folder of its own; creating a small marker file makes it
the current one. The marker names the folders that make up the version and the schema, so
that readers need not open files to infer it. A version may go on using folders of the
one before. File systems refuse to create an existing file, so of two writers that aim
for the same version only one can publish.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripmart.runtime import file_system

_MARKERS, _RETIRED, _LEASES = "_published", "_retired", "_leases"


class PublishConflict(RuntimeError):
    """Another writer published the same version first."""


def _published(spark: SparkSession, dest: str) -> list[int]:
    """Numbers of all versions that have a marker, rising."""
    fs, markers = file_system(spark, f"{dest}/{_MARKERS}")
    if not fs.exists(markers):
        return []
    return sorted(
        int(status.getPath().getName())
        for status in fs.listStatus(markers)
        if status.getPath().getName().isdigit()
    )


def version_marker(spark: SparkSession, dest: str, version: int) -> dict:
    """What a marker says of its version: folders, tag, schema and what its writer added."""
    fs, path = file_system(spark, f"{dest}/{_MARKERS}/{version:08d}")
    return _content(spark, fs, path)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _content(spark: SparkSession, fs, path) -> dict:
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _whole(spark: SparkSession, dest: str, version: int) -> bool:
    """Whether a marker was written to its end."""
    try:
        version_marker(spark, dest, version)
    except json.JSONDecodeError:
        return False
    return True


def current_version(spark: SparkSession, dest: str) -> int:
    """The newest version with a whole marker, 0 if there is none."""
    numbers = reversed(_published(spark, dest))
    return next((version for version in numbers if _whole(spark, dest, version)), 0)


def current_marker(spark: SparkSession, dest: str) -> dict | None:
    """The newest marker that is whole; one whose writer broke off is passed over."""
    version = current_version(spark, dest)
    return version_marker(spark, dest, version) if version else None


def snapshot_exists(spark: SparkSession, dest: str) -> bool:
    return current_marker(spark, dest) is not None


def marker_folders(marker: dict) -> list[str]:
    """The folders of a version below its destination; older markers name a single one."""
    return marker["folders"] if "folders" in marker else [marker["folder"]]


def snapshot_folders(spark: SparkSession, dest: str) -> list[str]:
    """The folders of the current version below ``dest``; none before the first."""
    marker = current_marker(spark, dest)
    return marker_folders(marker) if marker else []


def snapshot_tag(spark: SparkSession, dest: str) -> str | None:
    """The tag of the current version, from its writer or one before."""
    marker = current_marker(spark, dest)
    return marker["tag"] if marker else None


def read_snapshot(spark: SparkSession, dest: str, version: int | None = None) -> DataFrame:
    """The current version, or an older one by number."""
    marker = current_marker(spark, dest) if version is None else version_marker(spark, dest, version)
    if marker is None:
        raise FileNotFoundError(f"no snapshot published below {dest}")
    schema = StructType.fromJson(marker["schema"])
    return read_folders(spark, dest, marker_folders(marker), schema)


def read_folders(
    spark: SparkSession, dest: str, folders: list[str], schema: StructType
) -> DataFrame:
    """The rows of some folders below ``dest``; an empty frame for none."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{dest}/{folder}" for folder in folders])


def next_version(spark: SparkSession, dest: str) -> int:
    """The number after the newest marker, whole or not."""
    versions = _published(spark, dest)
    return versions[-1] + 1 if versions else 1


def unused_folder(version: int) -> str:
    """A folder name for a version that no other writer uses."""
    return f"v={version:08d}-{uuid.uuid4().hex}"


def publish_version(spark: SparkSession, dest: str, version: int, content: dict) -> int:
    """Make a written version the current one, unless another writer has taken its number."""
    fs, marker = file_system(spark, f"{dest}/{_MARKERS}/{version:08d}")
    try:
        stream = fs.create(marker, False)
    except Py4JJavaError as error:
        if fs.exists(marker):
            raise PublishConflict(f"{dest}: version {version} is already published") from error
        raise
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    return version


def publish_snapshot(
    df: DataFrame, dest: str, tag: str | None = None, partition_by: tuple[str, ...] = ()
) -> int:
    """Write ``df`` as the next version of ``dest`` and make it current.

    Without a tag the one of the version before goes on, so that a writer that knows
    nothing of tags does not lose what another has noted.
    """
    spark = df.sparkSession
    version = next_version(spark, dest)
    folder = unused_folder(version)
    if tag is None:
        tag = snapshot_tag(spark, dest) or ""
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{dest}/{folder}")
    content = {"folders": [folder], "tag": tag, "schema": df.schema.jsonValue()}
    return publish_version(spark, dest, version, content)


def _leased(spark: SparkSession, dest: str) -> set[int]:
    """Versions with a lease that has not run out; leases that have are removed."""
    fs, leases = file_system(spark, f"{dest}/{_LEASES}")
    if not fs.exists(leases):
        return set()
    held = set()
    for status in fs.listStatus(leases):
        version, ends, _ = status.getPath().getName().split("-")
        if int(ends) > time.time():
            held.add(int(version))
        else:
            fs.delete(status.getPath(), False)
    return held


@contextmanager
def leased_snapshot(
    spark: SparkSession, dest: str, seconds: int = 3600, version: int | None = None
) -> Iterator[DataFrame]:
    """The current version, or one by number, which no retention removes meanwhile.

    The lease ends with the block, or after ``seconds`` by the clocks of reader and
    remover if the reader dies. It is taken before the marker is looked at again, so a
    version that is being removed is either kept or not given out.
    """
    while True:
        wanted = version or current_version(spark, dest)
        if not wanted:
            raise FileNotFoundError(f"no snapshot published below {dest}")
        name = f"{wanted:08d}-{int(time.time()) + seconds}-{uuid.uuid4().hex}"
        fs, lease = file_system(spark, f"{dest}/{_LEASES}/{name}")
        fs.create(lease, False).close()
        if wanted in _published(spark, dest):
            break
        fs.delete(lease, False)
        if version is not None:
            raise FileNotFoundError(f"{dest}: version {version} is not there")
    try:
        yield read_snapshot(spark, dest, wanted)
    finally:
        fs.delete(lease, False)


def drop_old_versions(spark: SparkSession, dest: str, keep: int = 3) -> list[int]:
    """Remove all versions but the newest ``keep`` and those under a lease; their numbers.

    A marker is set aside before leases are looked at: a reader that came first has a
    lease by then, and the marker goes back. Then folders go that no remaining version
    names, and at last the marker. A removal that broke off is ended by the next one; two
    must not run at once.
    Folders that no marker ever named are left alone, since a writer may be at work there.
    """
    if keep < 1:
        raise ValueError("the current version cannot be removed")
    fs, retired = file_system(spark, f"{dest}/{_RETIRED}")
    fs.mkdirs(retired)
    markers = f"{dest}/{_MARKERS}"
    whole = [v for v in _published(spark, dest) if _whole(spark, dest, v)]
    held = _leased(spark, dest)
    for version in whole[:-keep]:
        if version not in held:
            name = f"{version:08d}"
            fs.rename(_path(spark, f"{markers}/{name}"), _path(spark, f"{dest}/{_RETIRED}/{name}"))
    gone, held = [], _leased(spark, dest)
    for name in sorted(s.getPath().getName() for s in fs.listStatus(retired)):
        aside = _path(spark, f"{dest}/{_RETIRED}/{name}")
        if int(name) in held:
            fs.rename(aside, _path(spark, f"{markers}/{name}"))
        else:
            gone.append((int(name), _content(spark, fs, aside)))
    used = {
        folder
        for version in _published(spark, dest)
        if _whole(spark, dest, version)
        for folder in marker_folders(version_marker(spark, dest, version))
    }
    for version, content in gone:
        for folder in set(marker_folders(content)) - used:
            fs.delete(_path(spark, f"{dest}/{folder}"), True)
            # The version's own folder goes with its last part.
            parent = _path(spark, f"{dest}/{folder}").getParent()
            if "/" in folder and not any(s.isDirectory() for s in fs.listStatus(parent)):
                fs.delete(parent, True)
        fs.delete(_path(spark, f"{dest}/{_RETIRED}/{version:08d}"), False)
    return [version for version, _ in gone]
