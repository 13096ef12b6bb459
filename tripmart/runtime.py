"""Session helpers: size-checked broadcasts, shared folders, file-system access."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Up to TINY_BYTES of input a side is safe to broadcast whatever its compression;
# up to CHECK_BYTES its rows are counted first; beyond that it is never hinted.
TINY_BYTES = 1 << 20
CHECK_BYTES = 64 << 20
BROADCAST_ROWS = 500_000


def input_bytes(df: DataFrame) -> int:
    """Bytes of all inputs below ``df``, from the optimizer's leaf statistics."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(
        int(str(leaves.apply(i).stats().sizeInBytes()))
        for i in range(leaves.size())
    )


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether the size of ``df`` has been checked and allows a broadcast.

    For frames that have at most as many rows as their inputs (masters, key lists).
    """
    size = input_bytes(df)
    if size > CHECK_BYTES:
        return False
    return size <= TINY_BYTES or df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only where the size of ``df`` has been checked.

    Without the hint the join shuffles and AQE splits skewed partitions.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that both sides are shuffled for.

    For a table of many short rows that was parked: Spark goes by the compressed size
    of its files and would broadcast millions of rows to every task.
    """
    return df.hint("merge")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    A temporary folder is made only in local mode with the setting absent.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tripmart-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared root, removed when the session's JVM ends."""
    path = f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    fs, hadoop_path = file_system(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


@contextmanager
def session_setting(spark: SparkSession, key: str, value):
    """A setting of the session within a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession):
    """Within the block a query's shuffle files go when it ends, as a write's may.

    Otherwise they stay on the disks until the driver happens to collect its garbage.
    """
    return session_setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", True)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once, as parquet in the shared folder."""
    path = f"{fresh_folder(df.sparkSession, 'cut')}/rows"
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def any_case(extension: str) -> str:
    """A glob for files of an extension in any letter case."""
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)


def names_of(kind: str) -> str:
    """A glob for the files of a kind: any delivered ones, and parts that a batch has landed.

    Landed text is compressed; other compressed files are of no kind.
    """
    return any_case(kind) if kind == "parquet" else f"{{{any_case(kind)},part-*.{kind}.gz}}"


def counted(
    df: DataFrame, name: str, which: Column | None = None
) -> tuple[DataFrame, Observation]:
    """``df`` with a count of its rows, or of ``which`` of them, taken while it is written."""
    seen = Observation(f"{name} {uuid.uuid4().hex}")
    rows = F.count(F.lit(1)) if which is None else F.count_if(which)
    return df.observe(seen, rows.alias("rows")), seen


def rows_seen(seen: Observation) -> int:
    """The count; 0 where Spark found nothing to write and left the counting out."""
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        return 0


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path as a Hadoop object."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path
