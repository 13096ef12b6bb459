"""Readers for landed files and for the tables of the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.runtime import any_case, file_system, names_of
from tripmart.sinks.snapshots import read_snapshot, snapshot_exists
from tripmart.sources.headers import csv_by_name, files_by_header


def _has_files(spark: SparkSession, path: str, extension: str) -> bool:
    """Whether any file of the extension lies at or below ``path``."""
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return False
    files = fs.listFiles(hadoop_path, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        landed = name.startswith("part-") and name.endswith(f".{extension}.gz")
        if name.lower().endswith("." + extension) or (landed and extension != "parquet"):
            return True
    return False


def _csv_with_header(
    spark: SparkSession, path: str, schema: T.StructType | None
) -> DataFrame:
    """Csv files whose headers all agree with the schema; without one, united by name."""
    reader = (
        spark.read.option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", names_of("csv"))
    )
    if schema is None:
        listing = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", names_of("csv"))
            .load(path)
        )
        groups = files_by_header(listing.select("path"))
        if len(groups) > 1:
            return csv_by_name(spark, groups).drop("_file")
        schema = reader.csv(path).schema
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_trips(
    spark: SparkSession, path: str, csv_schema: T.StructType | None = None
) -> DataFrame:
    """Landed trips: parquet, csv and json files below ``path``, told apart by extension.

    Csv and json as a batch has landed them (parts in gzip) are read as well.

    Csv and json columns stay text unless a schema is given: they are cast
    afterwards, so a bad value becomes NULL in one column instead of spoiling its
    row. Where kinds lie side by side they are united by column name; columns that
    one kind lacks are NULL there.
    """
    kinds = []
    if _has_files(spark, path, "parquet"):
        kinds.append(
            spark.read.option("recursiveFileLookup", True)
            .option("pathGlobFilter", any_case("parquet"))
            .option("mergeSchema", True)
            .parquet(path)
        )
    if _has_files(spark, path, "csv"):
        kinds.append(_csv_with_header(spark, path, csv_schema))
    if _has_files(spark, path, "json"):
        kinds.append(
            spark.read.option("recursiveFileLookup", True)
            .option("pathGlobFilter", names_of("json"))
            .option("primitivesAsString", True)
            .json(path)
        )
    if not kinds:
        raise FileNotFoundError(f"no parquet, csv or json trips below {path}")
    trips = kinds[0]
    for other in kinds[1:]:
        trips = _united(trips, other)
    return trips


def _united(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both by column name in any case, the second with the types of the first."""
    renames = {name.lower(): name for name in first.columns}
    for source, target in schemas.TRIP_RENAMES.items():
        if source in first.columns:
            renames[target] = source
    second = second.toDF(*[renames.get(name.lower(), name) for name in second.columns])
    typed = second.selectExpr(
        *[
            f"try_cast(`{name}` AS {first.schema[name].dataType.simpleString()}) AS `{name}`"
            if name in first.columns
            else f"`{name}`"
            for name in second.columns
        ]
    )
    return first.unionByName(typed, allowMissingColumns=True)


def read_reference(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A zone or vendor csv with header and a given schema."""
    return _csv_with_header(spark, path, schema)


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or ``None`` when there are no files in it."""
    return spark.read.parquet(path) if _has_files(spark, path, "parquet") else None


def register_catalog(spark: SparkSession, base: str, prefix: str = "") -> list[str]:
    """Temp views over the tables present below ``base``; returns their names.

    Schemas are fixed, so no files are opened to infer them; partition folders
    are discovered from the paths.
    """
    names = []
    for table, (folder, ddl) in schemas.CATALOG.items():
        path = f"{base}/{folder}"
        if _has_files(spark, path, "parquet"):
            spark.read.schema(ddl).parquet(path).createOrReplaceTempView(prefix + table)
            names.append(prefix + table)
    for table, folder in schemas.SNAPSHOTS.items():
        path = f"{base}/{folder}"
        if snapshot_exists(spark, path):
            read_snapshot(spark, path).createOrReplaceTempView(prefix + table)
            names.append(prefix + table)
    return names
