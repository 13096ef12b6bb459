"""Exact duplicates by two passes over a Bloom filter.

Pass one adds the digest of every text to a blocked Bloom filter that remembers, per
bit, whether it was set once or more often. Pass two probes the bits: a digest with a
bit that was set once cannot repeat, and its row passes straight through. Only the other
rows (the copies and about one in seventy of the rest) are shuffled and compared by
their full digests, so the filter never decides alone.

The filter has 16 bits a row in segments of 65,536 bits and at most ``max_bits`` (64 MB)
in all, which bounds the broadcast. Beyond that it only gets less selective: more rows
take the second, exact way.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import SPACES, parked

SEGMENT = 1 << 16
LONGS = SEGMENT // 64
MAX_BITS = 1 << 29


def _bare(text: Column) -> Column:
    """``text`` without white space.

    By bytes, one character after the other: ``translate`` makes a string of every
    character, which is garbage of many times the text in an executor's heap.
    """
    return reduce(lambda left, c: F.replace(left, F.lit(c), F.lit("")), SPACES, text)


def _digests(docs: DataFrame, id_col: str, text_col: str, *rest: str) -> DataFrame:
    """Id, digest of the normalised text and length of every row, then other columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Never null, and seen to be: else a join on it hashes every text once more to see.
    sha = F.coalesce(F.sha2(_bare(text), 256), F.lit(""))
    return docs.select(
        F.col(id_col).alias("_id"),
        sha.alias("_sha"),
        F.length(text).alias("_len"),
        *rest,
    )


def _with_bits(digests: DataFrame, segments: int) -> DataFrame:
    """The segment of a digest and its two different bits there."""
    h = F.xxhash64("_sha")
    first = F.shiftrightunsigned(h, 16).bitwiseAND(F.lit(SEGMENT - 1)).cast("int")
    step = F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(SEGMENT - 2)).cast("int") + 1
    seg = F.pmod(F.shiftrightunsigned(h, 48), segments).cast("int")
    return (
        # Seen to be never null, as the digest.
        digests.withColumn("_seg", F.coalesce(seg, F.lit(0)))
        .withColumn("_p", first)
        .withColumn("_q", (first + step).bitwiseAND(F.lit(SEGMENT - 1)))
    )


def _local_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits that a batch sets, by segment; a bit set more often is listed twice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        seg = batch.column(0).to_numpy().astype(np.int64)
        places = np.concatenate(
            [seg * SEGMENT + batch.column(i).to_numpy() for i in (1, 2)]
        )
        places, often = np.unique(places, return_counts=True)
        places = np.repeat(places, np.minimum(often, 2))
        segs, starts = np.unique(places // SEGMENT, return_index=True)
        bits = np.split((places % SEGMENT).astype(np.uint16), starts[1:])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(segs.astype(np.int32)),
                pa.array([b.tobytes() for b in bits], pa.binary()),
            ],
            ["_seg", "bits"],
        )


def _merge_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by segment, the bits that were set more than once."""

    def packed(seg: int, often: np.ndarray) -> pa.RecordBatch:
        longs = np.packbits(often > 1, bitorder="little").view("<i8")
        return pa.RecordBatch.from_arrays(
            [pa.array([seg], pa.int32()), pa.array([longs], pa.list_(pa.int64()))],
            ["_seg", "_bits"],
        )

    current, often = None, np.zeros(SEGMENT, np.uint8)
    for batch in batches:
        for seg, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if seg != current:
                if current is not None:
                    yield packed(current, often)
                current, often = seg, np.zeros(SEGMENT, np.uint8)
            set_here = np.bincount(np.frombuffer(bits, np.uint16), minlength=SEGMENT)
            often = np.minimum(often + set_here, 2).astype(np.uint8)
    if current is not None:
        yield packed(current, often)


def _build_filter(digests: DataFrame, max_bits: int) -> tuple[DataFrame, int]:
    """The bits set more than once, by segment, and the number of segments."""
    bits = min(max(SEGMENT, 16 * digests.count()), max_bits)
    segments = 1 << (bits // SEGMENT - 1).bit_length()
    merged = (
        _with_bits(digests, segments)
        .select("_seg", "_p", "_q")
        .mapInArrow(_local_filters, "_seg int, bits binary")
        .repartition("_seg")
        .sortWithinPartitions("_seg")
        .mapInArrow(_merge_filters, "_seg int, _bits array<bigint>")
    )
    return parked(merged, "bloom"), segments


def _probe(digests: DataFrame, filters: DataFrame, segments: int) -> DataFrame:
    """``digests`` with ``_suspect``: false where a digest surely occurs once."""

    def often(place: str):
        return F.getbit(F.get("_bits", F.shiftright(place, 6)), F.col(place) % 64) == 1

    # Bounded: at most max_bits / 8 bytes, whatever the number of rows.
    return (
        _with_bits(digests, segments)
        .join(F.broadcast(filters), "_seg")
        .withColumn("_suspect", often("_p") & often("_q"))
        .drop("_seg", "_p", "_q", "_bits")
    )


def _groups(
    docs: DataFrame, id_col: str, text_col: str, max_bits: int
) -> tuple[DataFrame, DataFrame, int]:
    digests = parked(
        _digests(docs, id_col, text_col).withColumn("_row", F.monotonically_increasing_id()),
        "digests",
    )
    filters, segments = _build_filter(digests, max_bits)
    marked = _probe(digests, filters, segments)
    single = marked.where("not _suspect").select(
        "_id",
        "_sha",
        "_len",
        F.col("_id").alias("keep_id"),
        F.col("_len").alias("keep_len"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.lit(False).alias("repeated"),
    )
    suspects = parked(marked.where("_suspect").drop("_suspect"), "suspects")
    # Both sides of the join are plain reads, so that AQE can split a digest that many
    # rows share; the groups themselves come from partial sums.
    first = F.min(F.struct(-F.col("_len"), F.col("_id").isNull(), "_id", "_row"))
    groups = parked(
        suspects.groupBy("_sha")
        .agg(F.count(F.lit(1)).alias("group_size"), first.alias("_first"))
        .select(
            "_sha",
            "group_size",
            F.col("_first._id").alias("keep_id"),
            F.col("_first._row").alias("_keep_row"),
            (-F.col("_first.col1")).alias("keep_len"),
        ),
        "groups",
    )
    same = F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_len") == F.col("keep_len"))
    compared = suspects.join(groups, "_sha").select(
        "_id",
        "_sha",
        "_len",
        "keep_id",
        "keep_len",
        "group_size",
        (F.col("_row") == F.col("_keep_row")).alias("kept"),
        (same & (F.col("_row") != F.col("_keep_row"))).alias("repeated"),
    )
    return single.unionByName(compared), filters, segments


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of ``docs``: its group of equal texts and whether it stays.

    Texts are equal when they are the same without white space; a null text is an empty
    one. The row with the longest original text stays, then the smallest id; a null id
    comes last, and of rows that repeat id and length as well one stays. Columns: the id,
    ``keep_id``, ``group_size``, ``kept``, ``text_sha256``. An empty table gives an empty
    result; other columns are not read.
    """
    rows, _, _ = _groups(docs, id_col, text_col, max_bits)
    return rows.select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        "kept",
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that the filter clears are passed on where they are read. Of the suspects those
    go whose id, digest and length are listed as copies; where the row that stays is
    itself repeated in all three, one of its rows is kept.
    """
    rows, filters, segments = _groups(docs, id_col, text_col, max_bits)
    copies = parked(rows.where("not kept"), "copies")
    gone = copies.where("not repeated").select("_id", "_sha", "_len").distinct()
    again = copies.where("repeated").select("_id", "_sha", "_len").distinct()
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    marked = _probe(_digests(docs, id_col, text_col, every), filters, segments)

    def named(left: DataFrame, right: DataFrame) -> DataFrame:
        """``left`` with ``_named``: true where ``right``, distinct, lists the row, else null."""
        match = (
            F.col("l._id").eqNullSafe(F.col("r._id"))
            & (F.col("l._sha") == F.col("r._sha"))
            & (F.col("l._len") == F.col("r._len"))
        )
        listed = right.withColumn("_named", F.lit(True)).alias("r")
        return left.alias("l").join(listed, match, "left").select("l.*", "r._named")

    # Not anti joins: Spark moves those below the probe, and shuffles every row with its text.
    left = named(marked.where("_suspect"), gone).where("_named is null").drop("_named")
    parts = [marked.where("not _suspect")]
    if again.isEmpty():
        parts.append(left)
    else:
        left = named(left, again)
        parts.append(left.where("_named is null").drop("_named"))
        repeated = left.where("_named").drop("_named")
        parts.append(repeated.dropDuplicates(["_id", "_sha", "_len"]))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select("_doc.*")
