"""Golden records, merges and edits of master data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.functions.text import normalize
from tripmart.operators.matching import match_pairs
from tripmart.operators.numbering import number_in_groups, number_rows
from tripmart.operators.scd2 import scd2_merge
from tripmart.runtime import broadcast_if_small
from tripmart.schemas import Domain


def source_trust(source: Column) -> Column:
    """Trust of a source system, 0 for an unknown one."""
    trust = F.lit(0)
    for name, level in schemas.SOURCE_TRUST.items():
        trust = F.when(F.lower(source) == name, level).otherwise(trust)
    return trust


def _is_empty(attr: Column, dtype: str) -> Column:
    """What counts against a record's rank: NULL, '' and also 0."""
    empty = attr.isNull()
    if dtype == "string":
        return empty | (attr == "")
    return empty | (attr.cast("double") == 0)


def _standing(df: DataFrame, attrs: tuple[str, ...], id_col: str) -> list[Column]:
    """Larger is better: few empty attributes, trust, late update, small id."""
    types = dict(df.dtypes)
    empties = sum(
        (F.when(_is_empty(F.col(a), types[a]), 1).otherwise(0) for a in attrs), F.lit(0)
    )
    updated = F.col("updated_at").cast("string") if "updated_at" in types else F.lit(None)
    source = F.col("source_system") if "source_system" in types else F.lit(None)
    return [
        (-empties).alias("filled"),
        source_trust(source).alias("trust"),
        F.coalesce(updated, F.lit("")).alias("updated"),
        (-F.col(id_col)).alias("age"),
    ]


def survivor_rank(
    df: DataFrame, group: str, attrs: tuple[str, ...], id_col: str
) -> DataFrame:
    """Rank of every record in its merge group, best first."""
    standing = F.struct(*_standing(df, attrs, id_col))
    return number_in_groups(
        df.withColumn("_standing", standing), [group], [F.col("_standing").desc()], "rank"
    ).drop("_standing")


def golden_record(
    df: DataFrame, group: str, attrs: tuple[str, ...], id_col: str
) -> DataFrame:
    """One row per merge group: best value of each attribute, counts, survivor.

    Every column is an aggregate with small partial results. The records and
    sources behind a group are rows of ``golden_sources``, however many there are.
    """
    types = dict(df.dtypes)
    standing = F.struct(*_standing(df, attrs, id_col))
    picked = []
    for a in attrs:
        filled = F.col(a).isNotNull()
        if types[a] == "string":
            filled = filled & (F.col(a) != "")
        picked.append(F.max_by(F.col(a), F.when(filled, F.col("_standing"))).alias(a))
    return (
        df.withColumn("_standing", standing)
        .groupBy(group)
        .agg(
            *picked,
            F.count(id_col).alias("source_count"),
            F.max_by(F.col(id_col), F.col("_standing")).alias("survivor_id"),
        )
    )


def golden_sources(df: DataFrame, group: str, id_col: str) -> DataFrame:
    """All records behind each golden record with their source, one row each."""
    source = F.when(F.col("source_system") != "", F.col("source_system"))
    return df.select(
        group, F.col(id_col).alias("source_id"), source.alias("source_system")
    ).filter("source_id IS NOT NULL")


def contributing_sources(df: DataFrame, group: str) -> DataFrame:
    """The distinct sources of each merge group, one row each."""
    named = F.col("source_system") != ""
    return df.filter(named).select(group, "source_system").distinct()


# --- merges by instruction ---------------------------------------------------------


def check_instructions(
    instructions: DataFrame, master: DataFrame, id_col: str
) -> tuple[DataFrame, DataFrame]:
    """Usable and refused merge instructions ``(survivor_id, duplicate_ids)``.

    Refused are those without survivor or duplicates, those whose survivor the
    master lacks, and those that share a record with another instruction: in a
    batch there is no order in which they could be applied one after the other.
    """
    complete = F.col("survivor_id").isNotNull() & (F.size(F.coalesce("duplicate_ids", F.array().cast("array<bigint>"))) > 0)
    named = F.explode(
        F.array_union(
            F.array(F.col("survivor_id").cast("bigint")),
            F.col("duplicate_ids").cast("array<bigint>"),
        )
    )
    numbered = instructions.withColumn(
        "_key", F.sha2(F.to_json(F.struct("survivor_id", "duplicate_ids")), 256)
    )
    uses = numbered.filter(complete).select("_key", "survivor_id", named.alias("_id"))
    shared = uses.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_id")
    overlapping = (
        uses.join(shared, "_id", "left_semi").select("_key").distinct().withColumn("_overlap", F.lit(True))
    )
    present = master.select(F.col(id_col).alias("survivor_id"), F.lit(True).alias("_present"))
    reason = (
        F.when(~complete, "survivor_id and duplicate_ids required")
        .when(F.col("_present").isNull(), "survivor not found")
        .when(F.col("_overlap"), "record in several instructions")
    )
    judged = (
        numbered.join(overlapping, "_key", "left")
        .join(present, "survivor_id", "left")
        .withColumn("refused", reason)
        .select(*instructions.columns, "refused")
    )
    return judged.filter("refused IS NULL").drop("refused"), judged.filter("refused IS NOT NULL")


def merge_groups(master: DataFrame, instructions: DataFrame, id_col: str) -> DataFrame:
    """The records each instruction names, with the survivor they merge into."""
    named = instructions.select(
        F.col("survivor_id").alias("merge_into"),
        F.explode(
            F.array_union(
                F.array(F.col("survivor_id").cast("bigint")),
                F.col("duplicate_ids").cast("array<bigint>"),
            )
        ).alias(id_col),
    )
    return master.join(named, id_col)


def merge_records(
    master: DataFrame, instructions: DataFrame, domain: Domain, now: str | None = None
) -> DataFrame:
    """The master after merging: survivors take the golden values, duplicates leave.

    The golden values go to the requested survivor, even where another record
    of the group ranks first. With ``now`` the survivors' updated_at is touched.
    """
    groups = merge_groups(master, instructions, domain.id_col)
    golden = golden_record(groups, "merge_into", domain.attrs, domain.id_col).select(
        F.col("merge_into").alias(domain.id_col),
        *[F.col(a).alias(f"_new_{a}") for a in domain.attrs],
        F.lit(True).alias("_merged"),
    )
    gone = instructions.select(
        "survivor_id", F.explode("duplicate_ids").alias(domain.id_col)
    ).filter(F.col(domain.id_col) != F.col("survivor_id")).select(domain.id_col)
    kept = master.join(gone, domain.id_col, "left_anti").join(golden, domain.id_col, "left")
    values = {
        a: F.when(F.col("_merged"), F.col(f"_new_{a}")).otherwise(F.col(a)) for a in domain.attrs
    }
    if now is not None and "updated_at" in master.columns:
        touched = F.lit(now).cast(master.schema["updated_at"].dataType)
        values["updated_at"] = F.when(F.col("_merged"), touched).otherwise(F.col("updated_at"))
    return kept.select(*[values.get(c, F.col(c)).alias(c) for c in master.columns])


def merge_best_score(master: DataFrame, instructions: DataFrame, domain: Domain) -> DataFrame:
    """Best score of the duplicates against the survivor, with its reason."""
    groups = merge_groups(master, instructions, domain.id_col).select(
        "merge_into", F.col(domain.id_col).alias("_id"), normalize(F.col(domain.match_col)).alias("b")
    )
    survivor = groups.filter(F.col("_id") == F.col("merge_into")).select(
        "merge_into", F.col("b").alias("a")
    )
    pairs = groups.filter(F.col("_id") != F.col("merge_into")).join(survivor, "merge_into")
    scored = match_pairs(pairs).filter("match_score > 0")
    best = scored.groupBy(F.col("merge_into").alias("survivor_id")).agg(
        F.max_by(
            F.struct("match_score", "reason"), F.struct(F.col("match_score"), -F.col("_id"))
        ).alias("_best")
    )
    return instructions.join(best, "survivor_id", "left").select(
        *instructions.columns,
        F.coalesce("_best.match_score", F.lit(0.0)).cast("decimal(5,4)").alias("match_score"),
        F.coalesce("_best.reason", F.lit("")).alias("reason"),
    )


def merge_audit(
    master: DataFrame,
    instructions: DataFrame,
    domain: Domain,
    merged_by: str,
    merged_at: str,
) -> DataFrame:
    """One audit row per instruction, to be appended to the merge history."""
    return merge_best_score(master, instructions, domain).select(
        F.lit(domain.name).alias("domain"),
        "survivor_id",
        "duplicate_ids",
        "match_score",
        "reason",
        F.lit(merged_by).alias("merged_by"),
        F.lit(merged_at).cast("timestamp_ntz").alias("merged_at"),
    )


def merge_history(audit: DataFrame) -> DataFrame:
    """The audit, newest first."""
    return audit.select(
        "domain", "survivor_id", "duplicate_ids", "match_score", "merged_at"
    ).orderBy(F.desc("merged_at"), "domain", "survivor_id")


def merge_then_version(
    master: DataFrame,
    history: DataFrame,
    instructions: DataFrame,
    domain: Domain,
    now: str,
    close_duplicates: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Merge, then version the survivors' new state: new master and new history.

    Current versions of the merged duplicates stay open unless
    ``close_duplicates`` is set; a key that a remaining record still has is
    never closed.
    """
    merged = merge_records(master, instructions, domain, now)
    survivors = merged.join(
        instructions.select(F.col("survivor_id").alias(domain.id_col)), domain.id_col, "left_semi"
    )
    changed = scd2_merge(
        survivors, history, domain.key_col, domain.history_attrs, now, "md5"
    )
    if close_duplicates:
        left = merged.select(F.col(domain.key_col).alias("natural_key")).distinct()
        ended = (
            merge_groups(master, instructions, domain.id_col)
            .select(F.col(domain.key_col).alias("natural_key"))
            .distinct()
            .join(left, "natural_key", "left_anti")
            .withColumn("_ended", F.lit(True))
        )
        stop = F.col("is_current") & F.coalesce("_ended", F.lit(False))
        at = F.lit(now).cast("timestamp_ntz")
        columns = changed.columns
        changed = changed.join(ended, "natural_key", "left").select(
            *[
                {
                    "valid_to": F.when(stop, at).otherwise(F.col("valid_to")),
                    "updated_at": F.when(stop, at).otherwise(F.col("updated_at")),
                    "is_current": F.col("is_current") & ~stop,
                }.get(c, F.col(c)).alias(c)
                for c in columns
            ]
        )
    return merged, changed


# --- edits ---------------------------------------------------------------------------


def apply_creates(
    master: DataFrame, new_rows: DataFrame, domain: Domain, order: list[Column], now: str
) -> DataFrame:
    """Insert records: recognised fields only, ids after the largest one in use."""
    fields = (domain.key_col, *domain.attrs, "source_system")
    present = [c for c in fields if c in new_rows.columns]
    if not present:
        raise ValueError("no recognised fields")
    largest = master.agg(F.coalesce(F.max(domain.id_col), F.lit(0))).scalar()
    numbered = number_rows(new_rows, order, "_n").select(*present, "_n")
    types = {f.name: f.dataType for f in master.schema}
    defaults = {
        "is_golden": F.lit(True),
        "created_at": F.lit(now).cast("timestamp_ntz"),
        "updated_at": F.lit(now).cast("timestamp_ntz"),
    }
    if "source_system" not in present:
        defaults["source_system"] = F.lit("manual_entry")
    else:
        numbered = numbered.withColumn(
            "source_system", F.coalesce("source_system", F.lit("manual_entry"))
        )
    rows = numbered.withColumn(domain.id_col, largest + F.col("_n"))
    rows = rows.select(
        *[
            (F.col(c) if c in rows.columns else defaults.get(c, F.lit(None)))
            .cast(types[c])
            .alias(c)
            for c in master.columns
        ]
    )
    return master.unionByName(rows)


def apply_updates(
    master: DataFrame, changes: DataFrame, domain: Domain, now: str
) -> DataFrame:
    """Partial updates by id: a change row names its fields in the array ``fields``.

    A field that is named is set, also to NULL; others keep their value. One
    change row per id.
    """
    sent = [a for a in domain.attrs if a in changes.columns]
    if not sent:
        raise ValueError("no updatable fields")
    side = changes.select(
        domain.id_col, F.col("fields").alias("_fields"), *[F.col(a).alias(f"_new_{a}") for a in sent]
    )
    joined = master.join(side, domain.id_col, "left")
    hit = F.coalesce(
        F.arrays_overlap("_fields", F.array(*[F.lit(a) for a in sent])), F.lit(False)
    )
    values = {
        a: F.when(
            F.coalesce(F.array_contains("_fields", a), F.lit(False)), F.col(f"_new_{a}")
        ).otherwise(F.col(a))
        for a in sent
    }
    if "updated_at" in master.columns:
        touched = F.lit(now).cast(master.schema["updated_at"].dataType)
        values["updated_at"] = F.when(hit, touched).otherwise(F.col("updated_at"))
    return joined.select(*[values.get(c, F.col(c)).alias(c) for c in master.columns])


def updated_records(master: DataFrame, changes: DataFrame, domain: Domain) -> DataFrame:
    """The updated rows of a master, to be versioned."""
    return master.join(changes.select(domain.id_col), domain.id_col, "left_semi")


def list_master(master: DataFrame, domain: Domain) -> DataFrame:
    """All records by id, each with the number of records."""
    total = master.agg(F.count(F.lit(1))).scalar()
    return master.withColumn("total", total).orderBy(domain.id_col)


def get_by_id(master: DataFrame, wanted: DataFrame, domain: Domain) -> DataFrame:
    """The records with the wanted ids (column ``id``)."""
    ids = wanted.select(F.col("id").alias(domain.id_col)).distinct()
    return master.join(broadcast_if_small(ids), domain.id_col, "left_semi")


def record_history(
    history: DataFrame, master: DataFrame, wanted: DataFrame, domain: Domain
) -> DataFrame:
    """Versions for each wanted id (column ``id``).

    The id is tried as natural key; only if that has no versions, it is taken
    as golden id and resolved. ``matched_by`` says which one it was.
    """
    ids = wanted.select("id").distinct()
    keys = history.select(F.col("natural_key").alias("id")).distinct()
    direct = ids.join(keys, "id", "left_semi").select(
        "id", F.col("id").alias("natural_key"), F.lit("natural_key").alias("matched_by")
    )
    resolved = (
        ids.join(keys, "id", "left_anti")
        .join(
            master.select(F.col(domain.id_col).alias("id"), F.col(domain.key_col).alias("natural_key")),
            "id",
        )
        .select("id", "natural_key", F.lit("golden_id").alias("matched_by"))
    )
    return direct.unionByName(resolved).join(history, "natural_key")


def split_golden(
    master: DataFrame, wanted: DataFrame, domain: Domain, now: str
) -> DataFrame:
    """Clone golden records as separate entities: new id, key + 1000, marked name."""
    clones = get_by_id(master, wanted, domain).withColumns(
        {
            domain.key_col: F.col(domain.key_col) + 1000,
            domain.match_col: F.concat(F.col(domain.match_col), F.lit(" (Split Output)")),
            "source_system": F.lit("manual_split"),
        }
    )
    return apply_creates(master, clones, domain, [F.col(domain.key_col), F.col(domain.id_col)], now)


def audit_events(
    audit: DataFrame, outcomes: DataFrame, summary: DataFrame, now: str
) -> DataFrame:
    """Merges, new versions and quality runs in one common event form."""
    merges = audit.select(
        F.col("merged_at").cast("string").alias("at"),
        F.col("merged_by").alias("user"),
        F.lit("MDM_MANUAL_MERGE").alias("action"),
        F.concat_ws("/", "domain", F.col("survivor_id").cast("string")).alias("entity"),
        F.lit("SUCCESS").alias("status"),
        F.concat(
            F.lit("merged "), F.size("duplicate_ids").cast("string"), F.lit(" duplicates")
        ).alias("details"),
    )
    versions = outcomes.filter("outcome IN ('inserted_new', 'versioned')").select(
        F.lit(now).alias("at"),
        F.lit("system").alias("user"),
        F.lit("SCD2_VERSION").alias("action"),
        F.concat(F.lit("history/"), F.col("natural_key").cast("string")).alias("entity"),
        F.lit("SUCCESS").alias("status"),
        F.col("outcome").alias("details"),
    )
    runs = summary.select(
        F.col("run_ts").alias("at"),
        F.lit("system").alias("user"),
        F.lit("DQ_RUN").alias("action"),
        F.concat(F.lit("run/"), F.col("run_id")).alias("entity"),
        F.when(F.col("status") == "PASS", "SUCCESS").otherwise("FAILURE").alias("status"),
        F.concat(F.lit("failed rules: "), F.col("failed_rule_count").cast("string")).alias("details"),
    )
    return merges.unionByName(versions).unionByName(runs)
