"""History of master data, one row per version (slowly changing dimension, type 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart import schemas
from tripmart.functions.hashing import record_hash
from tripmart.operators.numbering import number_rows
from tripmart.runtime import cut

PERIOD = ("valid_from", "valid_to", "is_current", "record_hash", "created_at", "updated_at")


def _ts(moment: str) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def most_complete_rows(df: DataFrame, key: str, attrs: tuple[str, ...]) -> DataFrame:
    """One row per key: most attributes filled, then newest, then smallest values."""
    filled = sum((F.when(F.col(a).isNotNull(), 1).otherwise(0) for a in attrs), F.lit(0))
    newest = [F.col("updated_at").desc_nulls_last()] if "updated_at" in df.columns else []
    others = [F.col(a).asc_nulls_last() for a in attrs]
    window = Window.partitionBy(key).orderBy(filled.desc(), *newest, *others)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def scd2_prepare(
    incoming: DataFrame, key: str, attrs: tuple[str, ...], algorithm: str = "sha256"
) -> DataFrame:
    """Incoming rows in the form the merge compares: natural key, attributes, hash."""
    return most_complete_rows(incoming, key, attrs).select(
        F.col(key).alias("natural_key"), *attrs, record_hash(attrs, algorithm).alias("record_hash")
    )


def _version(prepared: DataFrame, now: str) -> DataFrame:
    return prepared.withColumns(
        {
            "valid_from": _ts(now),
            "valid_to": _ts(schemas.HIGH_DATE),
            "is_current": F.lit(True),
            "created_at": _ts(now),
            "updated_at": _ts(now),
        }
    )


def scd2_initial(
    incoming: DataFrame, key: str, attrs: tuple[str, ...], now: str, algorithm: str = "sha256"
) -> DataFrame:
    """First load: every row is a current version."""
    return _version(scd2_prepare(incoming, key, attrs, algorithm), now).select(
        "natural_key", *attrs, *PERIOD
    )


def _compare(history: DataFrame, prepared: DataFrame) -> DataFrame:
    """Current versions beside incoming rows, each pair tagged once."""
    current = history.filter("is_current").select(
        F.col("natural_key").alias("_key"),
        F.struct(*[c for c in history.columns if c != "surrogate_key"]).alias("old"),
    )
    arrived = prepared.select(
        F.col("natural_key").alias("_in_key"), F.struct(*prepared.columns).alias("new")
    )
    outcome = (
        F.when(F.col("new").isNull(), "missing")
        .when(F.col("old").isNull(), "inserted_new")
        .when(F.col("old.record_hash") == F.col("new.record_hash"), "no_change")
        .otherwise("versioned")
    )
    return current.join(
        arrived, F.col("_key") == F.col("_in_key"), "full_outer"
    ).withColumn("outcome", outcome)


def scd2_merge(
    incoming: DataFrame,
    history: DataFrame | None,
    key: str,
    attrs: tuple[str, ...],
    now: str,
    algorithm: str = "sha256",
) -> DataFrame:
    """The history after a load, without surrogate keys.

    Closed versions pass by untouched and are not shuffled; current ones meet
    the incoming rows in one join, one row per key on either side. Keys that do
    not arrive stay as they are.
    """
    if history is None:
        return scd2_initial(incoming, key, attrs, now, algorithm)
    columns = ("natural_key", *attrs, *PERIOD)
    pairs = _compare(history, scd2_prepare(incoming, key, attrs, algorithm))

    def row(values: dict[str, Column]) -> Column:
        return F.struct(*[values[c].alias(c) for c in columns])

    kept = row({c: F.col(f"old.{c}") for c in columns})
    closed = row(
        {c: F.col(f"old.{c}") for c in columns}
        | {"valid_to": _ts(now), "is_current": F.lit(False), "updated_at": _ts(now)}
    )
    opened = row(
        {c: F.col(f"new.{c}") for c in ("natural_key", *attrs, "record_hash")}
        | {
            "valid_from": _ts(now),
            "valid_to": _ts(schemas.HIGH_DATE),
            "is_current": F.lit(True),
            "created_at": _ts(now),
            "updated_at": _ts(now),
        }
    )
    versions = (
        F.when(F.col("outcome").isin("missing", "no_change"), F.array(kept))
        .when(F.col("outcome") == "inserted_new", F.array(opened))
        .otherwise(F.array(closed, opened))
    )
    merged = pairs.select(F.inline(versions))
    return history.filter("NOT is_current").select(*columns).unionByName(merged)


def scd2_outcome(
    incoming: DataFrame,
    history: DataFrame,
    key: str,
    attrs: tuple[str, ...],
    algorithm: str = "sha256",
) -> DataFrame:
    """What a load does to each incoming key."""
    pairs = _compare(history, scd2_prepare(incoming, key, attrs, algorithm))
    return pairs.filter("new IS NOT NULL").select(
        F.col("new.natural_key").alias("natural_key"), "outcome"
    )


def with_surrogate_keys(
    history: DataFrame, attrs: tuple[str, ...], stable: bool = False
) -> DataFrame:
    """Number the versions 1..n by natural key and start; final column order.

    The numbers change when earlier versions are added. With ``stable`` a hash
    of natural key and start is added, which does not.
    """
    numbered = number_rows(
        history,
        [F.col("natural_key"), F.col("valid_from"), F.col("valid_to"), F.col("record_hash")],
        "surrogate_key",
    )
    columns = ["surrogate_key", "natural_key", *attrs, *PERIOD]
    if stable:
        # A stream's versions may start within a second of each other.
        whole = F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss")
        fraction = F.date_format("valid_from", ".SSSSSS")
        start = F.concat(whole, F.when(fraction != ".000000", fraction).otherwise(""))
        numbered = numbered.withColumn(
            "stable_key",
            F.sha2(F.concat_ws("||", F.col("natural_key").cast("string"), start), 256),
        )
        columns.append("stable_key")
    return numbered.select(*columns)


def continue_surrogate_keys(
    history: DataFrame, previous: DataFrame | None, attrs: tuple[str, ...]
) -> DataFrame:
    """Versions that ``previous`` has keep their keys; only the others are numbered.

    A version is its natural key, start and content. New ones are numbered after the
    highest key by natural key and start, so a load sorts what it adds, not all history,
    and a load that is repeated gives the same keys.
    """
    if previous is None:
        return with_surrogate_keys(history, attrs)
    version = ("natural_key", "valid_from", "record_hash")
    known = previous.select("surrogate_key", *[F.col(c).alias(f"_{c}") for c in version])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in version]
    plain = history.drop("surrogate_key")
    matched = cut(plain.join(known, same[0] & same[1] & same[2], "left").drop(*[f"_{c}" for c in version]))
    last = previous.agg(F.coalesce(F.max("surrogate_key"), F.lit(0))).first()[0]
    order = [F.col(c) for c in ("natural_key", "valid_from", "valid_to", "record_hash")]
    fresh = number_rows(
        matched.where("surrogate_key IS NULL").drop("surrogate_key"), order, "_number"
    ).withColumn("surrogate_key", F.col("_number") + F.lit(last))
    columns = ["surrogate_key", "natural_key", *attrs, *PERIOD]
    return (
        matched.where("surrogate_key IS NOT NULL").select(*columns).unionByName(fresh.select(*columns))
    )


def scd2_check(history: DataFrame) -> DataFrame:
    """Broken rules of a history; no rows when all versions chain up.

    Starts and ends are counted by key and time, then by key; both counts are
    aggregates with partial results, so a key with very many versions is spread
    over the cluster, and the history is read once.
    """
    one, none = F.lit(1), F.lit(0)
    events = history.select(
        "natural_key",
        F.inline(
            F.array(
                F.struct(
                    F.col("valid_from").alias("at"),
                    one.alias("start"),
                    none.alias("end"),
                    none.alias("closed"),
                    F.col("is_current").cast("int").alias("current"),
                    (F.col("valid_from") >= F.col("valid_to")).cast("int").alias("empty"),
                ),
                F.struct(
                    F.col("valid_to").alias("at"),
                    none.alias("start"),
                    one.alias("end"),
                    (~F.col("is_current")).cast("int").alias("closed"),
                    none.alias("current"),
                    none.alias("empty"),
                ),
            )
        ),
    )
    counts = ("start", "end", "closed", "current", "empty")
    moments = events.groupBy("natural_key", "at").agg(*[F.sum(c).alias(c) for c in counts])
    begun = F.col("start") > 0
    unpreceded = F.when(F.col("end") == 0, F.col("start")).otherwise(0)
    per_key = moments.groupBy("natural_key").agg(
        (F.sum("current") != 1).cast("bigint").alias("not one current version"),
        F.sum("empty").alias("empty interval"),
        F.count_if(F.col("start") > 1).alias("two versions start together"),
        F.count_if(F.col("end") > 1).alias("two versions end together"),
        F.sum(F.when(F.col("start") == 0, F.col("closed")).otherwise(0)).alias(
            "no version follows"
        ),
        # Nothing has to come before the first start.
        (
            F.sum(unpreceded) - F.coalesce(F.min_by(unpreceded, F.when(begun, F.col("at"))), none)
        ).alias("no version precedes"),
    )
    kinds = [c for c in per_key.columns if c != "natural_key"]
    found = F.flatten(
        F.array(*[F.array_repeat(F.lit(kind), F.col(f"`{kind}`").cast("int")) for kind in kinds])
    )
    return per_key.select("natural_key", F.explode(found).alias("violation"))
