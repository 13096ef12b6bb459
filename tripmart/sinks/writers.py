"""Writers for the zones of the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.runtime import counted, file_system, fresh_folder, rows_seen, shuffles_removed
from tripmart.sources.headers import csv_by_name, files_by_header
from tripmart.sources.landing import incoming_manifest


def gathered(df: DataFrame, by: tuple[str, ...], digests: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the rows of a value of ``by`` in few tasks, a large value in several.

    Texts in ``digests`` that are lower-case hexadecimal move as bytes, half as long, since
    a shuffle's compression finds nothing in them; any other text moves as it is.
    """
    packed, texts = {}, {}
    for c in [c for c, t in df.dtypes if c in digests and t == "string"]:
        fits = F.coalesce(F.lower(F.hex(F.unhex(c))) == F.col(c), F.lit(False))
        packed |= {f"_{c}_bytes": F.when(fits, F.unhex(c)), c: F.when(~fits, F.col(c))}
        texts[c] = F.coalesce(F.lower(F.hex(f"_{c}_bytes")), F.col(c))
    moved = df.withColumns(packed) if packed else df
    moved = moved.hint("rebalance", *[F.col(c) for c in by])
    return moved.withColumns(texts).select(*df.columns) if packed else moved


def write_zone(
    df: DataFrame,
    dest: str,
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
    only_touched: bool = False,
    sort_by: tuple[str, ...] = (),
    gather: bool = True,
) -> None:
    """Overwrite a dataset, or with ``only_touched`` just the partitions in ``df``.

    Rows are gathered by partition value first, so a task writes few folders
    rather than all; the rebalance splits a value that holds much of the data.
    Without ``gather`` rows stay where they are: for one partition value, or rows that
    lie by it already. ``sort_by`` orders the rows of each file.
    """
    if partition_by and gather:
        df = gathered(df, partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with shuffles_removed(df.sparkSession):
        writer.save(dest)


def append_rejects(rejected: DataFrame, dest: str, rejected_at=None) -> bool:
    """Append rejected rows with the time of rejection; nothing is written for none."""
    if rejected.isEmpty():
        return False
    stamp = F.current_timestamp() if rejected_at is None else F.lit(rejected_at).cast("timestamp")
    rejected.withColumn("_rejected_at", stamp).write.mode("append").parquet(dest)
    return True


def append_rows(df: DataFrame, dest: str) -> None:
    """Append rows, such as rule results and run summaries."""
    df.write.mode("append").parquet(dest)


def append_run(df: DataFrame, dest: str, run_id: str) -> None:
    """Append the rows of a run unless they are there from an attempt before."""
    spark = df.sparkSession
    fs, path = file_system(spark, dest)
    if fs.exists(path):
        known = spark.read.schema(df.schema).parquet(dest).filter(F.col("run_id") == run_id)
        if not known.isEmpty():
            return
    append_rows(df, dest)


def _landing_log(spark: SparkSession, base: str, source: str) -> DataFrame:
    """Files that earlier batches have landed."""
    schema = "batch string, raw_key string, length bigint, modification_time timestamp"
    log = f"{base}/raw/_landed/{source}"
    fs, path = file_system(spark, log)
    if not fs.exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(log)


def _compression(kind: str) -> dict[str, str]:
    """Options of a landed kind; landed text is large and repeats itself much."""
    if kind == "parquet":
        return {"compression": "zstd"}
    return {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def land_raw(spark: SparkSession, base: str, source: str, batch_id: str) -> int:
    """Copy the new valid files of one source into ``raw/<source>/batch=<id>``."""
    if not _landing_log(spark, base, source).filter(F.col("batch") == batch_id).isEmpty():
        return 0
    return land_files(spark, base, source, batch_id, incoming_manifest(spark, base))


def land_files(
    spark: SparkSession, base: str, source: str, batch_id: str, manifest: DataFrame
) -> int:
    """Copy the valid files of one source in ``manifest`` into ``raw/<source>/batch=<id>``.

    New are files that no earlier batch has landed in the same length and time. Each
    kind of file has a folder; columns are matched by name, and ``_landed_from`` says
    below ``incoming`` which file a row is from. Csv and json are landed as gzip. A batch that is landed again is
    left as it is, one that broke off is written anew. Returns the rows landed.
    """
    log = _landing_log(spark, base, source)
    if not log.filter(F.col("batch") == batch_id).isEmpty():
        return 0
    # A listing has one row a file, as has any plan that scans them.
    files = parked_listing(
        manifest.filter("valid")
        .filter(F.col("raw_key").startswith(f"raw/{source}/"))
        .join(log, ["raw_key", "length", "modification_time"], "left_anti")
    )
    paths = [row.path for row in files.select("path").collect()]
    target, landed = f"{base}/raw/{source}/batch={batch_id}", 0
    root = f"{base}/incoming/".split("://")[-1].split(":")[-1]
    at = F.locate(root, F.col("_landed_from"))
    inside = F.when(at > 0, F.substr("_landed_from", at + len(root))).otherwise(F.col("_landed_from"))
    for kind in schemas.LANDING_EXTENSIONS:
        chosen = [path for path in paths if path.lower().endswith("." + kind)]
        if not chosen:
            continue
        if kind == "csv":
            listed = files.filter(F.lower("path").endswith(".csv"))
            rows = csv_by_name(spark, files_by_header(listed)).withColumnRenamed(
                "_file", "_landed_from"
            )
        else:
            reader = spark.read.option("mergeSchema", True).option("primitivesAsString", True)
            rows = (reader.parquet if kind == "parquet" else reader.json)(
                *chosen if kind == "parquet" else [chosen]
            ).withColumn("_landed_from", F.col("_metadata.file_path"))
        rows, seen = counted(rows.withColumn("_landed_from", inside), kind)
        writer = rows.write.mode("overwrite").option("header", True).options(**_compression(kind))
        writer.format(kind).save(f"{target}/{kind}")
        landed += rows_seen(seen)
    if paths:
        # One file a batch: every later batch opens all files of the log.
        append_rows(
            files.select(
                F.lit(batch_id).alias("batch"), "raw_key", "length", "modification_time"
            ).coalesce(1),
            f"{base}/raw/_landed/{source}",
        )
    return landed


def parked_listing(files: DataFrame) -> DataFrame:
    """The listing as it is now, in the shared folder: files may arrive meanwhile."""
    path = f"{fresh_folder(files.sparkSession, 'listing')}/files"
    files.write.parquet(path)
    return files.sparkSession.read.schema(files.schema).parquet(path)
