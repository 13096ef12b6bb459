"""Mixing sources to target weights by systematic sampling.

Every document of a source has an expected number of copies, the source's target over
its size. The documents of a source are laid out in one order, their expected copies are
added up, a random offset of the source is added, and a document is taken once for each
whole number that its stretch crosses. Ordered by size, the taken words come within a
few documents of the target, and no document is taken more often than its expectation
rounded up.

The running sum is exact: expectations are whole numbers of 2**-30 copies, so the
result depends neither on the order of addition nor on the partitioning. Rows are
range-partitioned by source, size and id, so a source that holds most of the rows lies in
many partitions; within a partition a window adds up, and one row per source and
partition carries the sum of the partitions before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import parked, word_count

# Fixed values of the mix: weights by rank of the source, total and highest share.
WEIGHTS = (5, 2, 1)
TOTAL = 1.5
MOST = 2
UNIT = 1 << 30


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, most: int = MOST
) -> DataFrame:
    """Sources (``source``, ``source_size``) with ``target``.

    The sources share ``total`` times the sum of the sizes by their weights, which repeat
    in code point order, null last. A target stops at ``most`` times the size; what is
    over is shared again by weight among the others until no target is too high. The
    number of sources is that of a small dimension; one row each is ranked here.
    """
    ranked = sizes.withColumn(
        "_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn(
        "_weight",
        F.get(F.array(*[F.lit(w) for w in weights]), F.col("_rank") % len(weights)).cast("long"),
    )
    # In the order of cap per weight the sources that reach their cap come first: source
    # k is below its cap if, with all before it at theirs, its share is not above it.
    order = Window.orderBy(
        (F.col("source_size") * most / F.col("_weight")).asc(), F.col("_rank").asc()
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    cap = F.col("source_size") * most
    return (
        ranked.withColumn("_all", F.sum("source_size").over(every) * F.lit(total))
        .withColumn("_capped", F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("_open", F.sum("_weight").over(after))
        .withColumn("_share", F.col("_weight") * (F.col("_all") - F.col("_capped")) / F.col("_open"))
        # Once a source is below its cap, it and all after it divide what is left there.
        .withColumn("_below", F.col("_share") <= cap)
        .withColumn(
            "_level",
            F.first(
                F.when(F.col("_below"), F.struct("_all", "_capped", "_open")), ignorenulls=True
            ).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
        .select(
            "source",
            "source_size",
            F.when(
                F.col("_level").isNotNull(),
                F.col("_weight")
                * (F.col("_level._all") - F.col("_level._capped"))
                / F.col("_level._open"),
            )
            .otherwise(cap.cast("double"))
            .alias("target"),
        )
    )


def offset(source: Column, seed: int) -> Column:
    """The random start of a source in units, 0 to 2**30 - 1, the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, 7), 16, 10).cast("long") * 4


def systematic_copies(
    rows: DataFrame, group: str, expected: str, order: list[str], seed: int = 1
) -> DataFrame:
    """``rows`` with ``copies``: whole numbers crossed by the running sum in the group.

    ``expected`` counts copies in units of 2**-30. ``order`` should tell all rows of a
    group apart; rows that are the same in all of it may change places. Whole copies are
    set apart before anything is added up, and only the remainder of a partition's sum is
    carried to the next, so a group's sum may exceed any integer type.
    """
    remainder = F.col(expected).bitwiseAND(F.lit(UNIT - 1))
    keys = [group, *order]
    ranged = parked(
        rows.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranged"
    )
    pieces = ranged.groupBy("_part", group).agg(
        F.sum(remainder).bitwiseAND(F.lit(UNIT - 1)).alias("_sum")
    )
    earlier = (
        Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per partition and source in it: at most sources plus partitions.
    pieces = parked(
        pieces.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop(
            "_sum"
        ),
        "pieces",
    ).withColumnsRenamed({"_part": "_p", group: "_g"})
    here = (
        Window.partitionBy("_part", group)
        .orderBy(*[F.col(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    end = F.col("_end") + F.col("_before") + offset(F.col(group), seed)
    return (
        ranged.withColumn("_end", F.sum(remainder).over(here))
        .join(pieces, (F.col("_part") == F.col("_p")) & _same(group, "_g"))
        .withColumn("_end", end)
        .withColumn(
            "copies",
            F.shiftright(expected, 30)
            + F.shiftright("_end", 30)
            - F.shiftright(F.col("_end") - remainder, 30),
        )
        .drop("_part", "_p", "_g", "_end", "_before")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    total: float = TOTAL,
    most: int = MOST,
    seed: int = 1,
) -> DataFrame:
    """How often each document is taken: id, ``source``, ``size``, ``source_size``,
    ``target``, ``copies``, ``taken`` (words).

    A null text has no words; a source without words has the target 0. A null source is
    a source of its own, also beside one that is called "null". Repeated rows are rows of
    their own. An empty table gives an empty result.
    """
    sized = parked(
        docs.select(
            F.col(id_col).alias(id_col),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
        ),
        "sizes",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = parked(source_targets(sizes, weights, total, most), "targets").withColumnRenamed(
        "source", "_source"
    )
    expected = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)
    ).otherwise(F.lit(0))
    rows = sized.join(targets, _same("source", "_source")).withColumn(
        "_expected", expected.cast("long")
    )
    return (
        systematic_copies(rows.drop("_source"), "source", "_expected", ["size", id_col], seed)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_expected")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", **how) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix` takes it.

    Rows that share id, source and size are told apart by nothing that matters to the
    mix: they get the sum of their copies in turn. An empty table gives an empty one with
    its columns.
    """
    plan = (
        mix(docs, id_col, text_col, source_col, **how)
        .groupBy(F.col(id_col).alias("_id"), F.col("source").alias("_source"), "size")
        .agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    )
    plan = parked(plan.withColumnRenamed("size", "_words"), "plan")
    match = (
        _same("d._id", "p._id") & _same("d._source", "p._source")
        & (F.col("d._words") == F.col("p._words"))
    )
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("_source"),
        word_count(F.col(text_col)).alias("_words"),
    )
    joined = keyed.alias("d").join(plan.where("_copies > 0").alias("p"), match).select(
        "d._doc", "d._id", "d._source", "d._words", "_copies", "_rows"
    )
    alone = joined.where("_rows = 1")
    if plan.where("_rows > 1").isEmpty():
        dealt = alone
    else:
        turn = F.row_number().over(
            Window.partitionBy("_id", "_source", "_words").orderBy(F.xxhash64("_doc"))
        )
        each = F.floor(F.col("_copies") / F.col("_rows")) + F.when(
            turn <= F.col("_copies") % F.col("_rows"), 1
        ).otherwise(0)
        shared = joined.where("_rows > 1").withColumn("_copies", each)
        dealt = alone.unionByName(shared)
    return dealt.select(
        "_doc", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))
    ).select("_doc.*")
