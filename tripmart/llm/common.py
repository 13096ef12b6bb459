"""Shared by the operators: words, tables, and results parked in the shared folder."""

from __future__ import annotations

import re
from array import array

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.runtime import fresh_folder

# The characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def parked(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: a lost executor costs the tasks that read it, not what made it,
    and values that depend on the order of evaluation are fixed.
    """
    path = f"{fresh_folder(df.sparkSession, label)}/table"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def fold(key: Column, parts: int) -> Column:
    """The remainder of the CRC-32 of a value's text, as the label splits use it."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % parts


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int
) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` of at most ``most`` documents outside a fold.

    The documents are chosen by a hash of the id, from ids and labels alone; the texts of
    the chosen ones are picked out where they are read.
    """
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(fold(F.col("doc_id"), folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    chosen = parked(
        marked.join(docs.select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most),
        "chosen",
    )
    # Bounded: at most ``most`` ids.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def hashed_sample(docs: DataFrame, key: str, text: str, most: int, longest: int) -> DataFrame:
    """The ``text`` of at most ``most`` documents of up to ``longest`` characters.

    Chosen by a hash of the id. A threshold on the hash leaves about four times as many
    documents of the whole table, so tasks send few texts to the one that picks.
    """
    share = min(1.0, 4 * most / max(docs.count(), 1))
    choice, words = F.xxhash64(F.col(f"`{key}`")), F.col(f"`{text}`")
    return (
        docs.where(F.pmod(choice, F.lit(1 << 40)) < int(share * (1 << 40)))
        .where(F.length(words).between(1, longest))
        .orderBy(choice, words)
        .limit(most)
        .select(words.alias("text"))
    )


class Known(dict):
    """Codes of the byte strings met so far, and what ``describe`` says of each.

    What is known is forgotten between batches once it is more than ``most`` strings, so
    memory is bounded.
    """

    def __init__(self, describe, most: int = 200_000) -> None:
        super().__init__()
        self.describe, self.most, self.rows = describe, most, []

    def __missing__(self, part: bytes) -> int:
        self[part] = code = len(self)
        self.rows.append(self.describe(part))
        return code

    def begin_batch(self) -> None:
        if len(self) > self.most:
            self.clear()
            del self.rows[:]


class Measured(Known):
    """Known strings with ``width`` numbers for each, packed."""

    def __init__(self, describe, width: int, most: int = 200_000) -> None:
        super().__init__(describe, most)
        self.width, self.rows = width, array("f")

    def __missing__(self, part: bytes) -> int:
        self[part] = code = len(self)
        self.rows.extend(self.describe(part))
        return code

    def table(self) -> np.ndarray:
        """A row of numbers by code."""
        return np.array(self.rows, np.float32).reshape(-1, self.width)


def utf8(value) -> bytes:
    """The bytes of an Arrow string, a null as an empty one."""
    return value.as_buffer().to_pybytes() if value.is_valid else b""
