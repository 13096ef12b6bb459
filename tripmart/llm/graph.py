"""Connected components by alternating star contractions, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import parked


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
    return tuple(row)


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, for all nodes of ``links``.

    Each round hangs the larger neighbours of every node on its smallest one (large
    star), then its smaller neighbours (small star); both keep what is connected. After
    about log(n) rounds each component is one star. Edges that repeat are merged before
    they are shuffled by node, and no neighbour list is ever collected.
    """
    low, high = F.least(left, right), F.greatest(left, right)
    edges = parked(
        links.select(high.alias("hi"), low.alias("lo")).where("hi <> lo").distinct(), "edges"
    )
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        smallest = both.groupBy("hi").agg(F.least("hi", F.min("lo")).alias("top"))
        large = (
            both.where("lo > hi")
            .join(smallest, "hi")
            .select(F.col("lo").alias("hi"), F.col("top").alias("lo"))
            .distinct()
        )
        tops = large.groupBy("hi").agg(F.min("lo").alias("top"))
        small = (
            large.join(tops, "hi")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("hi"), F.col("top").alias("lo")),
                        F.struct(F.col("lo").alias("hi"), F.col("top").alias("lo")),
                    )
                ).alias("e")
            )
            .select("e.*")
            .where("hi <> lo")
            .distinct()
        )
        edges = parked(small, "stars")
    stars = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return stars.unionByName(roots)
