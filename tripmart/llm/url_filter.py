"""URL rules by a sort-merge range join.

A rule names a host and the beginning of a path and fits that host with all its
subdomains. A key is a host with its labels reversed, a separator and a path:
``com.example.www/`` for ``www.example.com``. A url has one key for itself and each
parent domain; a rule fits if its key begins one of them, so every rule is an interval of
the sorted keys. Distinct keys and rules are merged in key order, range-partitioned, and
a stack holds the rules whose intervals are open: its top is the longest that fits.

Intervals that begin in an earlier range are sent along to each range they reach into,
which one row per range tells; there are never more of them than nested rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import parked
from tripmart.runtime import broadcast_if_small

# The rules of the registered query (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = "\x01"  # below every other character of a key


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a url; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, UPPER, LOWER), F.regexp_extract(tail, r"^[^?#]*", 0)


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit(SEPARATOR), path)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and key, rules before urls: each url with its open rules' top."""
    part, stack = None, []
    for batch in batches:
        found_key, found_rule = [], []
        for row_part, key, rule in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if row_part != part:
                part, stack = row_part, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                if not stack or stack[-1][0] != key:
                    stack.append((key, rule))
            elif stack:
                found_key.append(key)
                found_rule.append(stack[-1][1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(found_key, pa.string()), pa.array(found_rule, pa.string())],
            ["_key", "rule"],
        )


def _fitting(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """Keys that begin with a rule, with the longest such rule."""
    ranged = parked(
        keys.repartitionByRange("_key").withColumn("_part", F.spark_partition_id()), "keys"
    )
    # One row per partition: a proven bound, so the join with the rules may broadcast it.
    ranges = ranged.groupBy("_part").agg(F.min("_key").alias("_lo"), F.max("_key").alias("_hi"))
    ends = F.concat(F.col("_rule_key"), F.lit("\U0010ffff"))
    reach = rules.join(
        F.broadcast(ranges), (F.col("_rule_key") <= F.col("_hi")) & (ends >= F.col("_lo"))
    )
    both = ranged.select("_part", "_key", F.lit(None).cast("string").alias("rule")).unionByName(
        reach.select("_part", F.col("_rule_key").alias("_key"), "rule")
    )
    return (
        both.repartition("_part")
        .sortWithinPartitions("_part", "_key", F.col("rule").asc_nulls_last())
        .mapInArrow(_sweep, "_key string, rule string")
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = DEFAULT,
) -> DataFrame:
    """Every row of ``pages`` with host, path, rule and verdict.

    ``rules`` has verdict, host and path. The rule with the longest text (host and path)
    wins; of equal rules block wins. Without a rule the verdict is ``default``. A null url
    or one without ``://`` has empty host and path and no rule. Repeated rows and ids are
    judged row by row; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col), F.coalesce(host, F.lit("")).alias("host"),
                        F.coalesce(path, F.lit("")).alias("path"))
    rules = parked(
        rules.select(
            F.coalesce("host", F.lit("")).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            "verdict",
        )
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            F.concat("host", "path").alias("rule"),
            "verdict",
            _key(_reversed_labels(F.col("host")), F.col("path")).alias("_rule_key"),
            F.array_join(_reversed_labels(F.col("host")), ".").alias("_domain"),
        ),
        "rules",
    )
    distinct = parked(rows.where("host <> ''").select("host", "path").distinct(), "urls")
    labels = _reversed_labels(F.col("host"))
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.array_join(F.slice(labels, 1, n), "."),
    )
    variants = distinct.select("host", "path", F.explode(parents).alias("_domain")).join(
        broadcast_if_small(rules.select("_domain").distinct()), "_domain", "left_semi"
    )
    variants = variants.select(
        "host", "path", F.concat("_domain", F.lit(SEPARATOR), "path").alias("_key")
    )
    fits = _fitting(variants.select("_key").distinct(), rules.select("rule", "_rule_key"))
    longest = F.max(F.struct(F.length("rule").alias("n"), "rule")).alias("_best")
    best = variants.join(fits, "_key").groupBy("host", "path").agg(longest)
    # The winners by host and path and the rows are plain reads: AQE splits a common url.
    best = parked(best.select("host", "path", F.col("_best.rule").alias("rule")), "winners")
    verdicts = broadcast_if_small(rules.select("rule", F.col("verdict")))
    return (
        rows.join(best, ["host", "path"], "left")
        .join(verdicts, "rule", "left")
        .select(
            id_col, "host", "path", "rule",
            F.coalesce("verdict", F.lit(default)).alias("verdict"),
        )
    )
