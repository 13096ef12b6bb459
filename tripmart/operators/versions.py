"""Rows joined with the version that was valid at a time of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.operators.numbering import ranged_rows


def join_versions(
    rows: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    columns: tuple[str, ...],
    prefix: str = "",
) -> DataFrame:
    """``rows`` with ``columns`` of the version of ``key`` that was valid at ``at``.

    The start of a version belongs to it, its end does not. Rows before the first version,
    in a gap, or without key or time get nulls, as in a left range join; of versions that
    start together the one that ends last counts. Versions and rows are laid out in one
    order of key and time and cut into ranges, so a key with very many of both spreads over
    many tasks; each range goes on from the last version that the ranges before it hold.
    """
    taken = [prefix + c for c in columns]
    version = F.struct("valid_to", *[F.col(c).alias(p) for c, p in zip(columns, taken)])
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    starts = history.where("natural_key IS NOT NULL AND valid_from < valid_to").select(
        F.col("natural_key").alias("_key"),
        F.col("valid_from").alias("_at"),
        F.col("valid_to").alias("_end"),
        version.alias("_version"),
    )
    asked = rows.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{at}`").alias("_at"), row.alias("_row"))
    # A version goes before the rows of its moment: its end is not null and sorts last
    # among versions, and rows, which have none, come after.
    order = [F.col("_key"), F.col("_at"), F.col("_end").asc_nulls_last()]
    ranged = ranged_rows(starts.unionByName(asked, allowMissingColumns=True), order)
    here = Window.partitionBy("_part", "_key").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # One row per key and range that has versions of it; few keys span more than one range.
    held = ranged.where("_version IS NOT NULL").groupBy("_key", "_part").agg(
        F.max_by("_version", "_pos").alias("_held")
    )
    pieces = ranged.select("_key", "_part").where("_key IS NOT NULL").distinct().join(
        held, ["_key", "_part"], "left"
    )
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(
        "_key", "_part", F.last("_held", ignorenulls=True).over(before).alias("_carried")
    ).where("_carried IS NOT NULL")
    found = (
        ranged.withColumn("_known", F.last("_version", ignorenulls=True).over(here))
        .where("_row IS NOT NULL")
        .join(carried, ["_key", "_part"], "left")
        .withColumn("_valid", F.coalesce("_known", "_carried"))
        .withColumn("_valid", F.when(F.col("_at") < F.col("_valid.valid_to"), F.col("_valid")))
    )
    return found.select("_row.*", *[F.col(f"_valid.`{p}`").alias(p) for p in taken])
