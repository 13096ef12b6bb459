"""Landed files: the manifest with a verdict per file, schema drift, inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.runtime import file_system, names_of
from tripmart.sinks.snapshots import snapshot_folders


def _file_listing(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and time of all files below ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modification_time"))
    )


def _empty_files(spark: SparkSession, path: str) -> DataFrame:
    """Files without content, which Spark's own listing leaves out."""
    fs, hadoop_path = file_system(spark, path)
    rows = []
    files = fs.listFiles(hadoop_path, True)
    while files.hasNext():
        status = files.next()
        if status.getLen() == 0:
            rows.append((status.getPath().toString(), 0, status.getModificationTime()))
    return spark.createDataFrame(rows, "path string, length bigint, at bigint").select(
        "path", "length", F.timestamp_millis("at").alias("modification_time")
    )


def _below(path: Column, base: str) -> Column:
    """The part of a file path below the folder ``base``."""
    root = base.rstrip("/").split("://")[-1].split(":")[-1]
    return F.regexp_replace(path, r"^.*?\Q" + root + r"\E/", "")


def judged_files(listing: DataFrame, base: str) -> DataFrame:
    """Files of the incoming zone, each with a verdict and its key in the raw zone."""
    relative = _below(F.col("path"), f"{base}/incoming")
    extension = F.lower(F.regexp_extract(relative, r"\.([^./]+)$", 1))
    reason = F.when(
        ~extension.isin(*schemas.LANDING_EXTENSIONS), F.lit("unsupported file type")
    ).when(F.col("length") == 0, F.lit("empty file"))
    return listing.select(
        "path",
        "length",
        "modification_time",
        reason.isNull().alias("valid"),
        reason.alias("reason"),
        F.concat(F.lit("raw/"), relative).alias("raw_key"),
    )


def incoming_manifest(spark: SparkSession, base: str) -> DataFrame:
    """All files in the incoming zone now, judged."""
    incoming = f"{base}/incoming"
    listing = _file_listing(spark, incoming).unionByName(_empty_files(spark, incoming))
    return judged_files(listing, base)


def schema_drift(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Missing, extra and retyped columns; from the schemas alone, without a scan."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    rows = [(c, "missing", t, None) for c, t in wanted.items() if c not in actual]
    rows += [(c, "extra", None, t) for c, t in actual.items() if c not in wanted]
    rows += [
        (c, "retyped", wanted[c], t)
        for c, t in actual.items()
        if c in wanted and wanted[c] != t
    ]
    return df.sparkSession.createDataFrame(
        rows, "column string, kind string, expected string, actual string"
    )


def drift_profile(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Schema drift with the number of values each retyped column would lose.

    One pass over the retyped columns only: a value is lost when it is not NULL
    but does not cast to the expected type.
    """
    drift = schema_drift(df, expected)
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    retyped = [
        f.name
        for f in df.schema
        if f.name in wanted and wanted[f.name] != f.dataType.simpleString()
    ]
    if not retyped:
        return drift.withColumn("lost_values", F.lit(None).cast("bigint"))
    counts = df.agg(
        *[
            F.count_if(
                F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(wanted[c]).isNull()
            ).alias(c)
            for c in retyped
        ]
    ).unpivot([], retyped, "column", "lost_values")
    return drift.join(counts, "column", "left")


def _live(spark: SparkSession, base: str, relative: Column) -> Column:
    """Whether a file counts: all but those of versions that a snapshot has left behind."""
    live = F.lit(True)
    for folder in schemas.SNAPSHOTS.values():
        current = snapshot_folders(spark, f"{base}/{folder}")
        if current:
            of_table = F.startswith(relative, F.lit(f"{folder}/"))
            # A folder of a version, or a part of one by key bucket.
            inside = F.regexp_extract(relative, f"^{folder}/([^/]+)/", 1)
            part = F.regexp_extract(relative, f"^{folder}/([^/]+/[^/]+)/", 1)
            live = live & (~of_table | inside.isin(current) | part.isin(current))
    return live


def _rows_by_zone(spark: SparkSession, base: str) -> DataFrame:
    """Rows of all live files by zone.

    Parquet rows come from the footers: a count without columns reads no column data.
    Csv files have a line each and a header, json files a line each.
    """
    relative = _below(F.col("_metadata.file_path"), base)
    zone = F.split(relative, "/")[0].alias("zone")
    kinds = []
    for kind in schemas.LANDING_EXTENSIONS:
        reader = spark.read.option("recursiveFileLookup", True).option(
            "pathGlobFilter", names_of(kind)
        )
        if kind == "parquet":
            rows = reader.schema("_none string").parquet(base)
        else:
            rows = reader.text(base)
        per_file = (
            rows.filter(_live(spark, base, relative))
            .groupBy(zone, F.col("_metadata.file_path").alias("file"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        header = 1 if kind == "csv" else 0
        kinds.append(per_file.groupBy("zone").agg(F.sum(F.col("n") - header).alias("rows")))
    return reduce(DataFrame.unionByName, kinds).groupBy("zone").agg(F.sum("rows").alias("rows"))


def lake_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Files, bytes, rows, partitions and last change of each zone of the lake.

    Parquet, csv and json files count, of snapshots only the current version.
    """
    relative = _below(F.col("path"), base)
    # Landed text is compressed, see ``names_of``.
    plain = F.regexp_replace("path", r"(/part-[^/]*\.(?:csv|json))\.gz$", "$1")
    listing = (
        _file_listing(spark, base)
        .filter(F.lower(F.regexp_extract(plain, r"\.([^./]+)$", 1)).isin(*schemas.LANDING_EXTENSIONS))
        .withColumn("relative", relative)
        .filter(_live(spark, base, F.col("relative")))
        # The folder of a version is no partition.
        .withColumn("relative", F.regexp_replace("relative", r"/v=\d+-[0-9a-f]+/", "/"))
    )
    files = listing.groupBy(F.split("relative", "/")[0].alias("zone")).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modification_time").alias("last_update"),
        F.count_distinct(
            F.regexp_extract("relative", r"^(.*/[^/=]+=[^/=]+)/[^/]+$", 1)
        ).alias("folders"),
        F.max(F.when(F.col("relative").rlike(r"^.*/[^/=]+=[^/=]+/[^/]+$"), 0).otherwise(1)).alias(
            "plain"
        ),
    )
    return files.join(_rows_by_zone(spark, base), "zone", "left").select(
        "zone",
        "files",
        "bytes",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        "last_update",
        (F.col("folders") - F.col("plain")).alias("partitions"),
    )
