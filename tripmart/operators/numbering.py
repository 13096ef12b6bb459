"""Exact row numbers without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.runtime import by_shuffle, cut


def ranged_rows(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` range-partitioned and sorted, with partition number and position.

    Kept by a checkpoint: the bounds of the ranges are sampled, so a second
    evaluation could cut them elsewhere.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    return cut(
        placed.withColumn("_part", F.shiftright("_place", 33)).withColumn(
            "_pos", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
        )
    ).drop("_place")


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Numbers 1..n over the whole frame; ``order`` should be total.

    The rows of a partition are numbered where they lie. Only one row per
    partition takes part in the running total that gives the offsets.
    """
    ranged = ranged_rows(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    # At most one row per shuffle partition, hence always small.
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_offset")
    )


def number_in_groups(
    df: DataFrame, group: list[str], order: list[Column], name: str
) -> DataFrame:
    """Numbers 1..n within each group, also for groups larger than a task.

    Like ``row_number``, but a group that spans several range partitions is
    numbered in parallel: its offset in a partition is the number of its rows in
    the partitions before. Most groups lie in one partition and need no offset.
    """
    ranged = ranged_rows(df, [*[F.col(g) for g in group], *order])
    pieces = ranged.groupBy(*group, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")
    )
    before = (
        Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    pieces = pieces.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    keys = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in (*group, "_part")]
    condition = keys[0]
    for key in keys[1:]:
        condition = condition & key
    return (
        ranged.alias("r")
        .join(by_shuffle(pieces).alias("p"), condition)
        .select(
            *[F.col(f"r.{c}") for c in df.columns],
            (F.col("p._offset") + F.col("r._pos") - F.col("p._first") + 1).alias(name),
        )
    )
