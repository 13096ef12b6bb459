"""Csv files whose headers differ: first lines are read in tasks, columns meet by name."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyarrow import fs as store
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE = 1 << 16
LONGEST_HEADER = 1 << 24


def opened(uri: str) -> tuple[store.FileSystem, str]:
    """The file system of a path as Spark names it, and the path on it."""
    if uri.startswith("file:"):
        return store.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return store.LocalFileSystem(), uri
    return store.FileSystem.from_uri(uri)


def first_line(uri: str) -> str:
    """The first line of a file, of which no more is read than the pieces it lies in."""
    files, path = opened(uri)
    line = b""
    with files.open_input_stream(path) as source:
        while b"\n" not in line and (piece := source.read(PIECE)):
            line += piece
            if len(line) > LONGEST_HEADER:
                raise ValueError(f"{uri}: no line ends within {LONGEST_HEADER} bytes")
    return line.split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8-sig", "replace")


def files_by_header(files: DataFrame) -> dict[str, list[str]]:
    """The files of a listing with a column ``path``, by first line."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part["header"] = part["path"].map(first_line)
            yield part[["path", "header"]]

    found = files.select("path").mapInPandas(read, "path string, header string")
    grouped = found.groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    return {row.header: sorted(row.paths) for row in sorted(grouped, key=lambda row: row.header)}


def csv_by_name(spark: SparkSession, groups: dict[str, list[str]]) -> DataFrame:
    """Csv files united by name, those with the same header read together, with ``_file``.

    A column that some files lack is NULL in their rows.
    """
    reader = spark.read.option("header", True)
    parts = [
        reader.option("enforceSchema", False).csv(paths).select("*", "_metadata.file_path")
        for paths in groups.values()
    ]
    parts = [part.withColumnRenamed("file_path", "_file") for part in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
