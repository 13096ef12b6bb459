"""The raw zone as a mirror of the landed files, byte for byte.

Executors copy the files, each in pieces of a fixed size, so neither the driver nor a
worker ever holds one. A file appears under its name only when it is complete, and a name
that exists is never written again: the same bytes count as present, others are refused.
The log has the checksum of every file, by batch.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as store
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.runtime import file_system
from tripmart.sinks.writers import append_rows, parked_listing
from tripmart.sources.headers import opened
from tripmart.sources.landing import incoming_manifest

PIECE = 8 << 20  # bytes that are copied at once
FILES_A_TASK = 16
LOG = (
    "batch string, raw_key string, length bigint, modification_time timestamp, "
    "sha256 string, status string"
)


def _digest(files: store.FileSystem, path: str, out=None) -> tuple[str, int]:
    """Checksum and length of a file, which is copied to ``out`` on the way."""
    state, size = hashlib.sha256(), 0
    with files.open_input_stream(path) as source:
        while piece := source.read(PIECE):
            state.update(piece)
            size += len(piece)
            if out is not None:
                out.write(piece)
    return state.hexdigest(), size


def _published(files: store.FileSystem, part: str, path: str) -> bool:
    """Give a finished file its name, unless the name is taken."""
    if isinstance(files, store.LocalFileSystem):
        try:
            os.link(part, path)  # fails if the name exists, in one step
        except FileExistsError:
            return False
        finally:
            os.unlink(part)
        return True
    if files.get_file_info(path).type != store.FileType.NotFound:
        files.delete_file(part)
        return False
    files.move(part, path)
    return True


def copy_file(source: str, target: str) -> tuple[str, str]:
    """Copy one file; its checksum, and ``copied``, ``present`` or ``refused``.

    Present is a target with the same bytes, refused one with others, which stays. A copy
    that breaks off leaves a hidden part at most, never a file under the name.
    """
    from_store, origin = opened(source)
    to_store, path = opened(target)
    if to_store.get_file_info(path).type == store.FileType.NotFound:
        folder, name = path.rsplit("/", 1)
        to_store.create_dir(folder, recursive=True)
        part = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with to_store.open_output_stream(part) as out:
            digest, _ = _digest(from_store, origin, out)
        if _published(to_store, part, path):
            return digest, "copied"
    else:
        digest, _ = _digest(from_store, origin)
    there, _ = _digest(to_store, path)
    return digest, "present" if there == digest else "refused"


def mirror_log(spark: SparkSession, base: str) -> DataFrame:
    """All files of all batches, with checksum and status."""
    log = f"{base}/raw/_mirrored"
    fs, path = file_system(spark, log)
    if not fs.exists(path):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(log)


def mirror_raw(spark: SparkSession, base: str, batch_id: str) -> DataFrame:
    """Copy all new valid files below ``incoming`` to the same place below ``raw``.

    Returns the batch's rows of the log: every file that it copied, found present with the
    same bytes, or refused since its name is taken by others. A file that an earlier batch
    has seen with the same length and time is not read again, unless it was refused: that
    is said every time. A batch that broke off may run again and finds its copies present;
    one that is done is left as it is. Without files there is nothing to log.
    """
    log = mirror_log(spark, base)
    done = log.filter(F.col("batch") == batch_id)
    if not done.isEmpty():
        return done
    seen = log.filter("status <> 'refused'").select("raw_key", "length", "modification_time")
    files = parked_listing(
        incoming_manifest(spark, base)
        .filter("valid")
        .join(seen, ["raw_key", "length", "modification_time"], "left_anti")
    )
    n = files.count()
    if not n:
        return spark.createDataFrame([], LOG)
    root = base if ":/" in base else f"file:{base}"

    def copy(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [
                copy_file(path, f"{root}/{key}") for path, key in zip(part["path"], part["raw_key"])
            ]
            part["sha256"], part["status"] = zip(*found)
            part["batch"] = batch_id
            yield part[["batch", "raw_key", "length", "modification_time", "sha256", "status"]]

    copied = (
        files.select("path", "raw_key", "length", "modification_time")
        .repartition(-(-n // FILES_A_TASK), "raw_key")
        .mapInPandas(copy, LOG)
    )
    append_rows(copied, f"{base}/raw/_mirrored")
    return mirror_log(spark, base).filter(F.col("batch") == batch_id)
