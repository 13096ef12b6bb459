"""The corpus pipeline: from raw documents to token digests, in five stages.

Each stage is a function of session, documents and table folder. Its result is written as
Parquet and read again as the documents of the next; all but the last return the columns
that they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from tripmart.llm.common import parked, table

NEAR_PERCENT = 80  # similarity of word shingles from which the stage takes texts as copies


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labels, does not reject."""
    return toxicity.fit(docs, table(spark, sf_dir, "labels")).keep_clean(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates at 0.8 and more."""
    return near_dedup.drop_near_copies(docs, percent=NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded text of every row."""
    return bpe.token_digests(bpe.encode_decode(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Trees and tokens are beyond SQL; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = parked(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
