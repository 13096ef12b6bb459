"""Master data: history, matching, survivorship, merges and edits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks.etl_queries import clean, fact
from checks.registry import avg2, query, ts
from checks.tables import Tables
from tripmart import schemas
from tripmart.functions.hashing import record_hash
from tripmart.functions.text import (
    levenshtein_similarity,
    normalize,
    token_set_similarity,
    tokens,
)
from tripmart.operators import (
    chained_merges,
    dimensions,
    matching,
    quality,
    scd2,
    survivorship,
    versions,
)
from tripmart.plans import analytics
from tripmart.runtime import cut, fresh_folder
from tripmart.schemas import VENDORS, ZONES
from tripmart.sinks.snapshots import (
    drop_old_versions,
    leased_snapshot,
    publish_snapshot,
    read_snapshot,
)

ZONE_ATTRS = ZONES.history_attrs
VENDOR_ATTRS = VENDORS.history_attrs
T0, T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
HIGH = schemas.HIGH_DATE

# --- history --------------------------------------------------------------------------


def hash_sql(attrs: tuple[str, ...], function: str = "sha256") -> str:
    joined = " || '||' || ".join(f"coalesce({a}, '')" for a in attrs)
    return f"{function}({joined})"


def first_load_sql(table: str, key: str, attrs: tuple[str, ...]) -> str:
    return f"""SELECT {key} AS natural_key, {', '.join(attrs)}, '{T0}' AS valid_from,
        '{HIGH}' AS valid_to, true AS is_current, {hash_sql(attrs)} AS record_hash,
        '{T0}' AS created_at, '{T0}' AS updated_at FROM {table}"""


def merge_sql(history: str, table: str, key: str, attrs: tuple[str, ...], now: str) -> str:
    """The history after a load, as three anti- or semi-joined parts."""
    cols = ", ".join(attrs)
    changed = "c.is_current AND i.h <> c.record_hash"
    return f"""
      (WITH hist AS ({history}),
            inc AS (SELECT *, {hash_sql(attrs)} AS h FROM ({table}))
       SELECT c.natural_key, {', '.join('c.' + a for a in attrs)}, c.valid_from,
              CASE WHEN {changed} THEN '{now}' ELSE c.valid_to END AS valid_to,
              CASE WHEN {changed} THEN false ELSE c.is_current END AS is_current,
              c.record_hash, c.created_at,
              CASE WHEN {changed} THEN '{now}' ELSE c.updated_at END AS updated_at
       FROM hist c LEFT JOIN inc i ON i.{key} = c.natural_key
       UNION ALL
       SELECT {key}, {cols}, '{now}', '{HIGH}', true, h, '{now}', '{now}' FROM inc
       WHERE NOT EXISTS (SELECT 1 FROM hist c WHERE c.is_current
                         AND c.natural_key = inc.{key} AND c.record_hash = inc.h))"""


ZONE_LOAD = first_load_sql("zone_master_0", "location_id", ZONE_ATTRS)
ZONE_MERGED = merge_sql(
    ZONE_LOAD, "SELECT * FROM zone_master_1", "location_id", ZONE_ATTRS, T1
)
VENDOR_LOAD = first_load_sql("vendors", "vendor_id", VENDOR_ATTRS)
VENDOR_MERGED = merge_sql(
    VENDOR_LOAD, "SELECT * FROM vendor_master_1", "vendor_id", VENDOR_ATTRS, T1
)
NUMBERED = "row_number() OVER (ORDER BY natural_key, valid_from) AS surrogate_key"
ZONE_TABLES = ("zone_master_0", "zone_master_1")
VENDOR_TABLES = ("vendors", "vendor_master_1")


def zone_load(t: Tables) -> DataFrame:
    return scd2.scd2_initial(t.master_zones(0), "location_id", ZONE_ATTRS, T0)


def zone_history(t: Tables) -> DataFrame:
    return scd2.scd2_merge(t.master_zones(1), zone_load(t), "location_id", ZONE_ATTRS, T1)


def vendor_history(t: Tables) -> DataFrame:
    load = scd2.scd2_initial(t.master_vendors(0), "vendor_id", VENDOR_ATTRS, T0)
    return scd2.scd2_merge(t.master_vendors(1), load, "vendor_id", VENDOR_ATTRS, T1)


COMPLETE = """
  SELECT location_id, borough, zone_name, service_zone FROM (
    SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY
        (CASE WHEN borough IS NULL THEN 0 ELSE 1 END)
        + (CASE WHEN zone_name IS NULL THEN 0 ELSE 1 END)
        + (CASE WHEN service_zone IS NULL THEN 0 ELSE 1 END) DESC,
        borough NULLS LAST, zone_name NULLS LAST, service_zone NULLS LAST) AS rn
    FROM zone_feed) WHERE rn = 1"""

query("most_complete_row", ("zone_feed",), COMPLETE)(
    lambda t: scd2.most_complete_rows(t.zone_feed().drop("row_no"), "location_id", ZONE_ATTRS)
)
query(
    "scd2_prepare",
    ("zone_feed",),
    f"""SELECT location_id AS natural_key, {', '.join(ZONE_ATTRS)},
          {hash_sql(ZONE_ATTRS)} AS record_hash FROM ({COMPLETE})""",
)(lambda t: scd2.scd2_prepare(t.zone_feed(), "location_id", ZONE_ATTRS))
query(
    "record_hash",
    (),
    """SELECT c_custkey, sha256(coalesce(c_name, '') || '||' || coalesce(c_mktsegment, ''))
         AS lake_hash, md5(coalesce(c_mktsegment, '') || '||' || coalesce(c_name, '')) AS store_hash
       FROM customer""",
)(
    lambda t: t.given("customer").select(
        "c_custkey",
        record_hash(("c_name", "c_mktsegment")).alias("lake_hash"),
        record_hash(("c_mktsegment", "c_name"), "md5").alias("store_hash"),
    )
)
query("scd2_initial", ("zone_master_0",), ZONE_LOAD)(zone_load)
query("scd2_merge", ZONE_TABLES, f"SELECT * FROM {ZONE_MERGED}")(zone_history)
query(
    "scd2_full_outer",
    ZONE_TABLES,
    """SELECT CASE WHEN i.location_id IS NULL THEN 'missing'
                   WHEN c.location_id IS NULL THEN 'inserted_new'
                   WHEN c.borough = i.borough AND c.zone_name = i.zone_name
                        AND c.service_zone = i.service_zone THEN 'no_change'
                   ELSE 'versioned' END AS outcome, count(*) AS keys
       FROM zone_master_0 c FULL OUTER JOIN zone_master_1 i USING (location_id) GROUP BY 1""",
)(
    lambda t: scd2._compare(
        zone_load(t), scd2.scd2_prepare(t.master_zones(1), "location_id", ZONE_ATTRS)
    )
    .groupBy("outcome")
    .agg(F.count(F.lit(1)).alias("keys"))
)
query(
    "scd2_union",
    ZONE_TABLES,
    f"""SELECT is_current, valid_from, valid_to, count(*) AS versions
        FROM {ZONE_MERGED} GROUP BY ALL""",
)(
    lambda t: zone_history(t)
    .groupBy("is_current", "valid_from", "valid_to")
    .agg(F.count(F.lit(1)).alias("versions"))
)
query(
    "scd2_outcome",
    ZONE_TABLES,
    f"""SELECT i.location_id AS natural_key,
          CASE WHEN c.location_id IS NULL THEN 'inserted_new'
               WHEN {hash_sql(tuple('c.' + a for a in ZONE_ATTRS), 'md5')}
                  = {hash_sql(tuple('i.' + a for a in ZONE_ATTRS), 'md5')} THEN 'no_change'
               ELSE 'versioned' END AS outcome
        FROM zone_master_1 i LEFT JOIN zone_master_0 c USING (location_id)""",
)(
    lambda t: scd2.scd2_outcome(
        t.master_zones(1),
        scd2.scd2_initial(t.master_zones(0), "location_id", ZONE_ATTRS, T0, "md5"),
        "location_id",
        ZONE_ATTRS,
        "md5",
    )
)
query("scd2_zone", ZONE_TABLES, f"SELECT *, {NUMBERED} FROM {ZONE_MERGED}")(
    lambda t: scd2.with_surrogate_keys(zone_history(t), ZONE_ATTRS)
)
query("scd2_vendor", VENDOR_TABLES, f"SELECT *, {NUMBERED} FROM {VENDOR_MERGED}")(
    lambda t: scd2.with_surrogate_keys(vendor_history(t), VENDOR_ATTRS)
)
query(
    "scd2_surrogate",
    ZONE_TABLES,
    f"""SELECT natural_key, valid_from, {NUMBERED},
          sha256(natural_key || '||' || valid_from) AS stable_key FROM {ZONE_MERGED}""",
)(
    lambda t: scd2.with_surrogate_keys(zone_history(t), ZONE_ATTRS, stable=True).select(
        "natural_key", "valid_from", "surrogate_key", "stable_key"
    )
)
query(
    "surrogate_keys",
    (),
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
         row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
                            l_extendedprice, l_discount, l_tax) AS surrogate_key FROM lineitem""",
)(
    lambda t: survivorship.number_rows(
        t.given("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax",
        ),
        [
            F.col(c)
            for c in (
                "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax",
            )
        ],
        "surrogate_key",
    ).drop("l_discount", "l_tax")
)

ZONE_REVISED = merge_sql(
    f"SELECT * FROM {ZONE_MERGED}", "SELECT * FROM zone_master_0", "location_id", ZONE_ATTRS, T2
)


def zone_replay(t: Tables) -> DataFrame:
    """A seed load and two more: the second undoes the changes of the first."""
    return scd2.scd2_merge(
        t.master_zones(0), zone_history(t), "location_id", ZONE_ATTRS, T2
    )


query("scd2_seed_replay", ZONE_TABLES, f"SELECT * FROM {ZONE_REVISED}")(zone_replay)


@query(
    "scd2_kept_keys",
    ZONE_TABLES,
    f"""SELECT *, row_number() OVER (ORDER BY valid_from, natural_key) AS surrogate_key
        FROM {ZONE_REVISED}""",
)
def _(t: Tables) -> DataFrame:
    """Three loads, each of which numbers only the versions that it adds."""
    keyed = scd2.continue_surrogate_keys(zone_load(t), None, ZONE_ATTRS)
    for snapshot, now in ((1, T1), (0, T2)):
        merged = scd2.scd2_merge(t.master_zones(snapshot), keyed, "location_id", ZONE_ATTRS, now)
        keyed = cut(scd2.continue_surrogate_keys(merged, keyed, ZONE_ATTRS))
    return keyed


@query(
    "trips_as_of",
    ("landed",),
    """WITH started AS (
          SELECT DISTINCT pu_location_id AS natural_key, year(pickup_datetime) AS y FROM landed),
        versions AS (
          SELECT natural_key, y, make_timestamp(y, 1 + natural_key % 12, 15, 0, 0, 0) AS valid_from,
            CASE WHEN (natural_key + y) % 5 = 0
              THEN make_timestamp(y, 1 + natural_key % 12, 28, 0, 0, 0)
              ELSE coalesce(lead(make_timestamp(y, 1 + natural_key % 12, 15, 0, 0, 0))
                OVER (PARTITION BY natural_key ORDER BY y), TIMESTAMP '9999-12-31') END AS valid_to
          FROM started)
        SELECT l_orderkey, pu_location_id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S')
            AS pickup_datetime, v.y AS pickup_version
        FROM landed LEFT JOIN versions AS v ON pu_location_id = natural_key
          AND valid_from <= pickup_datetime AND pickup_datetime < valid_to""",
)
def _(t: Tables) -> DataFrame:
    """Each trip with the version of its pickup zone at the time; some years have gaps."""
    trips = t.trips_landed().select(
        "l_orderkey",
        F.col("PULocationID").alias("pu_location_id"),
        F.col("tpep_pickup_datetime").alias("pickup_datetime"),
    )
    start = F.make_timestamp_ntz(
        F.col("y"), (1 + F.col("natural_key") % 12).cast("int"), F.lit(15), F.lit(0), F.lit(0), F.lit(0)
    )
    following = Window.partitionBy("natural_key").orderBy("y")
    history = (
        trips.select(
            F.col("pu_location_id").alias("natural_key"), F.year("pickup_datetime").alias("y")
        )
        .distinct()
        .withColumn("valid_from", start)
        .withColumn(
            "valid_to",
            F.when(
                (F.col("natural_key") + F.col("y")) % 5 == 0,
                F.col("valid_from") + F.expr("INTERVAL 13 DAYS"),
            ).otherwise(
                F.coalesce(
                    F.lead("valid_from").over(following), F.lit("9999-12-31").cast("timestamp_ntz")
                )
            ),
        )
    )
    return versions.join_versions(
        trips, history, "pu_location_id", "pickup_datetime", ("y",)
    ).withColumnRenamed("y", "pickup_version")


@query(
    "scd2_check",
    ZONE_TABLES,
    """SELECT location_id AS natural_key, 'no version follows' AS violation
       FROM zone_master_0 WHERE location_id % 7 = 0 AND location_id % 11 <> 0
         AND location_id % 3 = 0
       UNION ALL
       SELECT location_id, 'no version precedes' FROM zone_master_0
       WHERE location_id % 7 = 0 AND location_id % 11 <> 0 AND location_id % 3 = 0""",
)
def _broken(t: Tables) -> DataFrame:
    """A history in which the middle versions of every third changed key are lost."""
    lost = (
        (F.col("natural_key") % 3 == 0)
        & (F.col("valid_from") == F.lit(T1).cast("timestamp_ntz"))
        & ~F.col("is_current")
    )
    dest = fresh_folder(t.spark, "check")
    publish_snapshot(zone_replay(t).filter(~lost), dest)
    return scd2.scd2_check(read_snapshot(t.spark, dest))


@query("snapshot_swap", ZONE_TABLES, f"SELECT * FROM {ZONE_REVISED}")
def _swap(t: Tables) -> DataFrame:
    """Each load reads the snapshot it replaces."""
    dest = fresh_folder(t.spark, "swap")
    publish_snapshot(zone_load(t), dest)
    for snapshot, now in ((1, T1), (0, T2)):
        merged = scd2.scd2_merge(
            t.master_zones(snapshot), read_snapshot(t.spark, dest), "location_id", ZONE_ATTRS, now
        )
        publish_snapshot(merged, dest, partition_by=("is_current",))
    return read_snapshot(t.spark, dest)


@query(
    "snapshot_retention",
    ZONE_TABLES,
    f"""SELECT 1 AS version, * FROM ({ZONE_LOAD})
        UNION ALL BY NAME SELECT 3 AS version, * FROM {ZONE_REVISED}""",
)
def _retention(t: Tables) -> DataFrame:
    """Of three versions the newest stays, and the first, which is being read."""
    dest = fresh_folder(t.spark, "retention")
    publish_snapshot(zone_load(t), dest)
    publish_snapshot(zone_history(t), dest)
    publish_snapshot(zone_replay(t), dest)
    with leased_snapshot(t.spark, dest, version=1) as read:
        gone = drop_old_versions(t.spark, dest, keep=1)
        rows = read.withColumn("version", F.lit(1))
    newest = read_snapshot(t.spark, dest).withColumn("version", F.lit(3))
    kept = rows.unionByName(newest)
    return kept.filter(~F.col("version").isin(gone))


query(
    "dim_current",
    ZONE_TABLES,
    f"""SELECT surrogate_key, natural_key, {', '.join(ZONE_ATTRS)}, valid_from
        FROM (SELECT *, {NUMBERED} FROM {ZONE_MERGED}) WHERE is_current""",
)(
    lambda t: dimensions.current_rows(
        scd2.with_surrogate_keys(zone_history(t), ZONE_ATTRS), ZONE_ATTRS
    )
)
query(
    "dim_current_vendor",
    VENDOR_TABLES,
    f"""SELECT surrogate_key, natural_key, {', '.join(VENDOR_ATTRS)}, valid_from
        FROM (SELECT *, {NUMBERED} FROM {VENDOR_MERGED}) WHERE is_current""",
)(
    lambda t: dimensions.current_rows(
        scd2.with_surrogate_keys(vendor_history(t), VENDOR_ATTRS), VENDOR_ATTRS
    )
)
query(
    "point_in_time",
    ZONE_TABLES,
    f"""SELECT natural_key, zone_name, borough, service_zone, valid_from, valid_to
        FROM {ZONE_MERGED} WHERE valid_from <= '{T1}' AND '{T1}' < valid_to""",
)(
    lambda t: dimensions.as_of(zone_history(t), T1).select(
        "natural_key", "zone_name", "borough", "service_zone", "valid_from", "valid_to"
    )
)
query(
    "golden_count",
    ZONE_TABLES + VENDOR_TABLES,
    f"""SELECT 'zones' AS domain, count(DISTINCT natural_key) AS golden_records
        FROM {ZONE_MERGED} WHERE is_current
        UNION ALL SELECT 'vendors', count(DISTINCT natural_key) FROM {VENDOR_MERGED} WHERE is_current""",
)(lambda t: analytics.golden_count({"zones": zone_history(t), "vendors": vendor_history(t)}))
query(
    "current_vs_history",
    ZONE_TABLES + VENDOR_TABLES,
    f"""SELECT 'zones' AS domain, is_current, count(*) AS versions FROM {ZONE_MERGED} GROUP BY ALL
        UNION ALL SELECT 'vendors', is_current, count(*) FROM {VENDOR_MERGED} GROUP BY ALL""",
)(lambda t: analytics.current_vs_history({"zones": zone_history(t), "vendors": vendor_history(t)}))
query(
    "scd2_changes_by_month",
    ZONE_TABLES,
    f"""SELECT left(valid_from, 7) || '-01' AS month, count(*) AS versions
        FROM {ZONE_REVISED} WHERE NOT is_current GROUP BY 1""",
)(lambda t: analytics.scd2_changes_by_month(zone_replay(t)))
query(
    "vendor_performance",
    ("fact", *VENDOR_TABLES),
    f"""SELECT h.vendor_name, count(*) AS trips, {avg2('fare_amount', 4)} AS avg_fare,
          CAST(sum(tip_amount) AS DOUBLE) AS total_tips
        FROM fact f JOIN {VENDOR_MERGED} h ON h.natural_key = f.vendor_id AND h.is_current
        GROUP BY 1""",
)(
    lambda t: analytics.vendor_performance(fact(t), vendor_history(t)).withColumn(
        "avg_fare", F.round("avg_fare", 4)
    )
)
query(
    "change_history",
    ZONE_TABLES,
    f"""SELECT natural_key, zone_name, service_zone, is_current, valid_from, valid_to
        FROM {ZONE_MERGED}""",
)(lambda t: analytics.change_history(zone_history(t), ("zone_name", "service_zone")))

# --- matching ---------------------------------------------------------------------------

STOP = ", ".join(f"'{w}'" for w in schemas.STOP_WORDS)


def normal_sql(column: str) -> str:
    punct = r"""[!"#$%&''()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""
    return (
        f"trim(regexp_replace(regexp_replace(lower(coalesce({column}, '')), "
        f"'{punct}', ' ', 'g'), '\\s+', ' ', 'g'))"
    )


def tokens_sql(normal: str) -> str:
    return (
        f"list_distinct(list_filter(string_split({normal}, ' '), "
        f"lambda w: w <> '' AND w NOT IN ({STOP})))"
    )


VALUES = f"""v AS (SELECT normal, min(id) AS id, arg_min(name, id) AS value, count(*) AS records,
                   {tokens_sql('normal')} AS tok
            FROM (SELECT id, name, {normal_sql('name')} AS normal FROM names) GROUP BY normal)"""
TOKEN_SET = """CASE WHEN len(a.tok) = 0 AND len(b.tok) = 0 THEN 1.0
    WHEN len(a.tok) = 0 OR len(b.tok) = 0 THEN 0.0
    ELSE CAST(len(list_intersect(a.tok, b.tok)) AS DOUBLE)
      / (len(a.tok) + len(b.tok) - len(list_intersect(a.tok, b.tok))) END"""
LEVENSHTEIN = """CASE WHEN a.normal = '' AND b.normal = '' THEN 1.0
    WHEN a.normal = '' OR b.normal = '' THEN 0.0
    ELSE 1.0 - CAST(levenshtein(a.normal, b.normal) AS DOUBLE)
      / greatest(length(a.normal), length(b.normal)) END"""

query(
    "normalize_names",
    ("names",),
    f"""SELECT id, {normal_sql('name')} AS normal,
          array_to_string(list_filter(string_split({normal_sql('name')}, ' '),
            lambda w: w <> '' AND w NOT IN ({STOP})), ' ') AS short FROM names""",
)(
    lambda t: t.names().select(
        "id", normalize(F.col("name")).alias("normal"), normalize(F.col("name"), True).alias("short")
    )
)


def value_pairs(t: Tables, threshold: float) -> DataFrame:
    """Pairs of distinct names that may reach the threshold."""
    groups = matching.value_groups(t.names(), "id", "name")
    return matching.similar_within(matching.cut(groups.select("normal")), threshold)


@query(
    "token_set_similarity",
    ("names",),
    f"""WITH {VALUES}
        SELECT a.normal AS a, b.normal AS b, round({TOKEN_SET}, 6) AS token_set
        FROM v a JOIN v b ON a.normal < b.normal WHERE {TOKEN_SET} >= 0.6""",
)
def _(t: Tables) -> DataFrame:
    """All pairs of distinct names with a Jaccard similarity of 0.6 or more."""
    similarity = token_set_similarity(tokens(F.col("a")), tokens(F.col("b")))
    return (
        value_pairs(t, 0.8)
        .withColumn("token_set", F.round(similarity, 6))
        .filter("token_set >= 0.6")
        .select("a", "b", "token_set")
    )


@query(
    "fuzzy_levenshtein",
    ("names",),
    f"""WITH {VALUES}
        SELECT a.normal AS a, b.normal AS b, round({LEVENSHTEIN}, 6) AS fuzzy
        FROM v a JOIN v b ON a.normal < b.normal
        WHERE levenshtein(a.normal, b.normal) * 2 <= (length(a.normal) + length(b.normal))
              * (1 - 0.79995 / 0.95) AND a.normal <> ''""",
)
def _(t: Tables) -> DataFrame:
    """All pairs of distinct names within half the edit distance that a ratio allows.

    A replaced character counts as two unmatched ones, so these are pairs that
    the character filter must not lose.
    """
    total = F.length("a") + F.length("b")
    return (
        value_pairs(t, 0.8)
        .filter(F.levenshtein("a", "b") * 2 <= total * F.lit(1 - 0.79995 / 0.95))
        .select("a", "b", F.round(levenshtein_similarity(F.col("a"), F.col("b")), 6).alias("fuzzy"))
    )


# The character ratio in SQL: the longest common part, earliest in a, then in b, and
# again to its left and right. A candidate has similar tokens or few edits. printf
# rounds the binary value of a number, as the score does; round would not.
IN_SEGMENT = """list_max(flatten(list_transform(range(alo, ahi), lambda i: list_transform(
    list_filter(range(blo, bhi), lambda j: a[i + 1] = b[j + 1]),
    lambda j: 1000000 * len(list_filter(range(1, least(ahi - i, bhi - j) + 1),
                lambda k: a[i + 1:i + k] = b[j + 1:j + k])) + 1000 * (999 - i) + 999 - j))))"""
MAYBE = f"""({TOKEN_SET} >= 0.5999 OR levenshtein(a.normal, b.normal)
    <= (length(a.normal) + length(b.normal)) * (1 - 0.79995 / 0.95) + 1e-9)"""
SCORED = f"""
    ro AS (
      SELECT a, b, CAST(0 AS BIGINT) AS alo, length(a) AS ahi, CAST(0 AS BIGINT) AS blo,
             length(b) AS bhi, CAST(0 AS BIGINT) AS m FROM (SELECT DISTINCT a, b FROM cand)
      UNION ALL
      SELECT a, b, CASE side WHEN 0 THEN alo ELSE i + k END, CASE side WHEN 0 THEN i ELSE ahi END,
             CASE side WHEN 0 THEN blo ELSE j + k END, CASE side WHEN 0 THEN j ELSE bhi END,
             CASE side WHEN 0 THEN k ELSE 0 END
      FROM (SELECT *, best // 1000000 AS k, 999 - best // 1000 % 1000 AS i, 999 - best % 1000 AS j
            FROM (SELECT *, {IN_SEGMENT} AS best FROM ro WHERE alo < ahi AND blo < bhi)
            WHERE best IS NOT NULL), (VALUES (0), (1)) AS s(side)),
    ratios AS (
      SELECT a, b, CASE WHEN a = '' AND b = '' THEN 1.0 WHEN a = '' OR b = '' THEN 0.0
                   ELSE 2.0 * CAST(sum(m) AS DOUBLE) / (length(a) + length(b)) END AS fuzzy
      FROM ro GROUP BY a, b),
    scores AS (
      SELECT c.*, fuzzy, CASE WHEN c.a <> '' AND c.a = c.b THEN 1.0 ELSE
          CAST(printf('%.4f', greatest((token_set + fuzzy) / 2, 0.95 * fuzzy, 0.95 * token_set))
            AS DOUBLE) END AS match_score
      FROM cand c JOIN ratios r ON r.a = c.a AND r.b = c.b),
    hits AS (
      SELECT *, CASE WHEN a <> '' AND a = b THEN 'exact match (normalized)' ELSE
          printf('token_set=%.2f, fuzzy=%.2f, score=%.2f', token_set, fuzzy, match_score) END AS reason
      FROM scores WHERE match_score >= 0.8)"""
VALUE_HITS = f"""WITH RECURSIVE {VALUES},
    cand AS (SELECT a.normal AS a, b.normal AS b, {TOKEN_SET} AS token_set
             FROM v a JOIN v b ON a.normal < b.normal WHERE {MAYBE}), {SCORED}"""
DUPLICATES = f"""WITH RECURSIVE {VALUES},
    cand AS (SELECT a.normal AS a, b.normal AS b, {TOKEN_SET} AS token_set,
               a.id AS id_a, a.value AS value_a, a.records AS records_a,
               b.id AS id_b, b.value AS value_b, b.records AS records_b
             FROM v a JOIN v b ON a.id < b.id WHERE {MAYBE}), {SCORED}"""


def scored_values(t: Tables) -> DataFrame:
    return matching.match_pairs(value_pairs(t, 0.8)).filter("match_score >= 0.8")


query("fuzzy_ratio", ("names",), f"{VALUE_HITS} SELECT a, b, round(fuzzy, 6) AS fuzzy FROM hits")(
    lambda t: scored_values(t).select("a", "b", F.round("fuzzy", 6).alias("fuzzy"))
)
query("match_score", ("names",), f"{VALUE_HITS} SELECT a, b, match_score FROM hits")(
    lambda t: scored_values(t).select("a", "b", "match_score")
)
query("match_reason", ("names",), f"{VALUE_HITS} SELECT a, b, reason FROM hits")(
    lambda t: scored_values(t).select("a", "b", "reason")
)


@query(
    "candidate_pairs",
    ("names",),
    f"""WITH {VALUES}
        SELECT a.normal AS a, b.normal AS b FROM v a JOIN v b ON a.normal < b.normal
        WHERE {TOKEN_SET} >= 0.6 OR (levenshtein(a.normal, b.normal) * 2
          <= (length(a.normal) + length(b.normal)) * (1 - 0.79995 / 0.95) AND a.normal <> '')""",
)
def _(t: Tables) -> DataFrame:
    """The pairs that blocking must find: similar tokens, or few edits however they are counted."""
    total = F.length("a") + F.length("b")
    similarity = token_set_similarity(tokens(F.col("a")), tokens(F.col("b")))
    few = F.levenshtein("a", "b") * 2 <= total * F.lit(1 - 0.79995 / 0.95)
    return value_pairs(t, 0.8).filter((similarity >= 0.6) | few)


def asked(t: Tables) -> DataFrame:
    """Each distinct product name as a query, in capitals."""
    return (
        t.given("part")
        .groupBy("p_name")
        .agg(F.min("p_partkey").alias("query_id"))
        .select("query_id", F.upper("p_name").alias("query_name"))
    )


@query(
    "find_candidates",
    ("names",),
    f"""WITH RECURSIVE {VALUES},
        q AS (SELECT upper(p_name) AS query_value, min(p_partkey) AS query_id,
                     lower(p_name) AS normal, {tokens_sql('lower(p_name)')} AS tok
              FROM part GROUP BY p_name),
        cand AS (SELECT a.normal AS a, b.normal AS b, {TOKEN_SET} AS token_set, query_id,
                   query_value, b.normal AS candidate_normal, b.id AS candidate_id,
                   b.value AS candidate_value, b.records
                 FROM q a JOIN v b ON {MAYBE}
                 WHERE NOT (b.records = 1 AND b.id = a.query_id)), {SCORED}
        SELECT query_id, query_value, candidate_normal, candidate_id, candidate_value, records,
               match_score, reason, row_number() OVER (PARTITION BY query_id
                 ORDER BY match_score DESC, candidate_id, candidate_normal) AS rank FROM hits""",
)
def _(t: Tables) -> DataFrame:
    return matching.find_candidates(asked(t), t.names(), "query_id", "query_name", "id", "name")


@query(
    "candidate_rank",
    (),
    """SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand
         ORDER BY p_size DESC, p_partkey) AS rank FROM part""",
)
def _(t: Tables) -> DataFrame:
    """The ranking of candidates on products: per brand by size."""
    return matching.candidate_rank(
        t.given("part").select(
            F.col("p_brand").alias("query_id"),
            F.col("p_size").alias("match_score"),
            F.col("p_partkey").alias("candidate_id"),
            F.col("p_name").alias("candidate_normal"),
        )
    ).select(F.col("query_id").alias("p_brand"), F.col("candidate_id").alias("p_partkey"), "rank")


@query(
    "duplicate_candidates",
    ("names",),
    f"""{DUPLICATES} SELECT a, b, id_a, value_a, records_a, id_b, value_b, records_b, token_set,
          fuzzy, match_score, reason FROM hits""",
)
def _(t: Tables) -> DataFrame:
    return matching.duplicate_candidates(t.names(), "id", "name")


@query(
    "candidate_records",
    ("names",),
    f"""{DUPLICATES},
        sides AS (SELECT a AS normal, id_a AS query_id, value_a AS query_value, b AS other,
                    match_score, reason FROM hits)
        SELECT s.query_id, s.query_value, n.id AS record_id, n.name AS record_value,
          s.match_score, s.reason
        FROM sides s JOIN names n ON {normal_sql('n.name')} = s.other WHERE n.id <> s.query_id""",
)
def _(t: Tables) -> DataFrame:
    """All records behind the candidates of each value group's first record."""
    found = matching.duplicate_candidates(t.names(), "id", "name").select(
        F.col("id_a").alias("query_id"),
        F.col("value_a").alias("query_value"),
        F.col("b").alias("candidate_normal"),
        "match_score",
        "reason",
    )
    return matching.records_of_candidates(found, t.names(), "id", "name")


@query(
    "exact_copies",
    ("names",),
    f"""WITH n AS (SELECT id, name, {normal_sql('name')} AS normal FROM names)
        SELECT id, name AS value, n.normal, first_id FROM n
        JOIN (SELECT normal, min(id) AS first_id FROM n GROUP BY normal) f ON f.normal = n.normal
        WHERE n.normal <> '' AND id <> first_id""",
)
def _(t: Tables) -> DataFrame:
    return matching.exact_copies(t.names(), "id", "name")


@query(
    "token_candidates",
    ("names",),
    f"""WITH {VALUES}
        SELECT least(a.id, b.id) AS id_a, greatest(a.id, b.id) AS id_b,
          a.records * b.records AS pairs, round(0.95 * {TOKEN_SET}, 6) AS score
        FROM v a JOIN v b ON a.normal < b.normal WHERE 0.95 * {TOKEN_SET} >= 0.8 - 1e-9""",
)
def _(t: Tables) -> DataFrame:
    """Duplicate candidates by the token score alone, with the record pairs behind them."""
    groups = matching.cut(matching.value_groups(t.names(), "id", "name"))
    pairs = matching.similar_within(groups.select("normal"), 0.8)
    score = F.lit(0.95) * token_set_similarity(tokens(F.col("a")), tokens(F.col("b")))
    left = groups.select(F.col("normal").alias("a"), F.col("id").alias("x"), F.col("records").alias("n"))
    right = groups.select(F.col("normal").alias("b"), F.col("id").alias("y"), F.col("records").alias("m"))
    return (
        pairs.withColumn("score", F.round(score, 6))
        .filter("score >= 0.8 - 1e-9")
        .join(left, "a")
        .join(right, "b")
        .select(
            F.least("x", "y").alias("id_a"),
            F.greatest("x", "y").alias("id_b"),
            (F.col("n") * F.col("m")).alias("pairs"),
            "score",
        )
    )


@query(
    "candidate_count",
    ("names",),
    f"""{DUPLICATES} SELECT 'similar' AS kind,
          CAST(coalesce(sum(records_a * records_b), 0) AS DOUBLE) AS pairs FROM hits
        UNION ALL SELECT 'equal', CAST(sum(records * (records - 1) / 2) AS DOUBLE) FROM v""",
)
def _(t: Tables) -> DataFrame:
    found = matching.duplicate_candidates(t.names(), "id", "name")
    return matching.candidate_count(t.names(), "id", "name", found)


# --- survivorship, merges, edits ------------------------------------------------------------


def records(t: Tables) -> DataFrame:
    return t.vendor_records().withColumn("grp", F.col("vendor_id"))


query(
    "source_trust",
    ("standing",),
    "SELECT vendor_pk, trust FROM standing",
)(
    lambda t: t.vendor_records().select(
        "vendor_pk", survivorship.source_trust(F.col("source_system")).alias("trust")
    )
)
query("survivor_rank", ("ranked",), "SELECT grp, vendor_pk, rank FROM ranked")(
    lambda t: survivorship.survivor_rank(records(t), "grp", VENDORS.attrs, "vendor_pk").select(
        "grp", "vendor_pk", "rank"
    )
)
query("golden_record", ("golden",), "SELECT * FROM golden")(
    lambda t: survivorship.golden_record(records(t), "grp", VENDORS.attrs, "vendor_pk")
)
query(
    "golden_sources",
    ("vendor_records",),
    """SELECT vendor_id AS grp, vendor_pk AS source_id, nullif(source_system, '') AS source_system
       FROM vendor_records""",
)(lambda t: survivorship.golden_sources(records(t), "grp", "vendor_pk"))
query(
    "contributing_sources",
    ("vendor_records",),
    """SELECT DISTINCT vendor_id AS grp, source_system FROM vendor_records
       WHERE source_system <> ''""",
)(lambda t: survivorship.contributing_sources(records(t), "grp"))


def master(t: Tables) -> DataFrame:
    return t.vendor_records()


def instructions(t: Tables) -> DataFrame:
    return survivorship.check_instructions(t.merge_instructions(), master(t), "vendor_pk")[0]


MERGED_SQL = f"* REPLACE ({ts('updated_at')} AS updated_at)"

query("merge_records", ("merged",), f"SELECT {MERGED_SQL} FROM merged")(
    lambda t: survivorship.merge_records(master(t), instructions(t), VENDORS, T2)
)


@query(
    "merge_refused",
    (),
    """SELECT survivor_id, refused FROM (
         SELECT p_partkey AS survivor_id, 'survivor_id and duplicate_ids required' AS refused
         FROM part WHERE p_partkey % 3 = 2
         UNION ALL
         SELECT p_partkey + 100000000000, 'survivor not found' FROM part WHERE p_partkey % 5 = 0
         UNION ALL
         SELECT p_partkey, 'record in several instructions' FROM part
         WHERE p_partkey % 6 = 1 AND (p_partkey // 6) % 4 = 0)""",
)
def _(t: Tables) -> DataFrame:
    """Instructions without duplicates, for unknown survivors, and with shared records."""
    key = F.col("p_partkey")
    part = t.given("part").select("p_partkey")
    none = part.filter(key % 3 == 2).select(
        key.alias("survivor_id"), F.array().cast("array<bigint>").alias("duplicate_ids")
    )
    unknown = part.filter(key % 5 == 0).select(
        (key + 100_000_000_000).alias("survivor_id"), F.array(key + 200_000_000_000).alias("duplicate_ids")
    )
    shared = part.filter((key % 6 == 1) & (F.floor(key / 6) % 4 == 0)).select(
        key.alias("survivor_id"), F.array(F.lit(300_000_000_000)).alias("duplicate_ids")
    )
    _, refused = survivorship.check_instructions(
        none.unionByName(unknown).unionByName(shared), master(t), "vendor_pk"
    )
    return refused.select("survivor_id", "refused")


# Merges that build on each other, four in each block of eight records.
CHAIN = (
    "CASE WHEN b % 8 IN (1, 2) THEN b - b % 8 + 1 END",
    "CASE WHEN b % 8 IN (1, 3, 4) THEN b - b % 8 + 3 END",
    """CASE WHEN b // 8 % 2 = 1 AND b % 8 IN (2, 5) THEN b - b % 8 + 2
            WHEN b // 8 % 2 = 0 AND b % 8 IN (2, 3, 5) THEN b - b % 8 + 3 END""",
    "CASE WHEN b % 8 IN (3, 6) THEN b - b % 8 + 6 END",
)


def chain_orders(t: Tables) -> DataFrame:
    """The record merged last is gone in every second block's third instruction."""
    key = F.col("p_partkey")
    odd = F.floor(key / 8) % 2 == 1
    step = (
        F.when(key % 8 == 1, F.struct(F.lit(1).alias("at"), F.array(key + 1).alias("ids")))
        .when(key % 8 == 3, F.struct(F.lit(2).alias("at"), F.array(key - 2, key + 1).alias("ids")))
        .when((key % 8 == 2) & odd, F.struct(F.lit(3).alias("at"), F.array(key + 3).alias("ids")))
        .when(key % 8 == 6, F.struct(F.lit(4).alias("at"), F.array(key - 3).alias("ids")))
    )
    third = F.struct(F.lit(3).alias("at"), F.array(key + 2, key - 1).alias("ids"))
    steps = F.array_compact(F.array(step, F.when((key % 8 == 3) & ~odd, third)))
    return (
        t.given("part")
        .select(key.alias("survivor_id"), F.explode(steps).alias("step"))
        .select("survivor_id", "step.at", F.col("step.ids").alias("duplicate_ids"))
    )


def chain_sql(tail: str) -> str:
    """The merges of a chain as one step after the other."""
    text = ["m0 AS (SELECT * FROM vendor_records)"]
    for i, into in enumerate(CHAIN, 1):
        empties = " + ".join(f"(coalesce({a}, '') = '')::INT" for a in VENDORS.attrs)
        best = ", ".join(
            f"arg_min({a}, rank) FILTER (coalesce({a}, '') <> '') AS {a}" for a in VENDORS.attrs
        )
        values = ", ".join(
            f"CASE WHEN g.into_pk IS NULL THEN m.{a} ELSE g.{a} END AS {a}" for a in VENDORS.attrs
        )
        text += [
            f"""n{i} AS (SELECT *, {into.replace("b ", "vendor_pk ")} AS into_pk FROM m{i - 1})""",
            f"""l{i} AS (SELECT *, row_number() OVER (PARTITION BY into_pk ORDER BY {empties},
                  CASE lower(source_system) WHEN 'tlc_registry' THEN 3 WHEN 'partner_feed' THEN 2
                    WHEN 'manual_entry' THEN 1 ELSE 0 END DESC, updated_at DESC, vendor_pk) AS rank
                FROM n{i} WHERE into_pk IN (SELECT vendor_pk FROM m{i - 1}))""",
            f"g{i} AS (SELECT into_pk, {best} FROM l{i} GROUP BY into_pk)",
            f"""m{i} AS (SELECT m.vendor_pk, m.vendor_id, {values}, m.source_system,
                  CASE WHEN g.into_pk IS NULL THEN m.updated_at
                    ELSE TIMESTAMP '{T2}' END AS updated_at
                FROM m{i - 1} m LEFT JOIN g{i} g ON g.into_pk = m.vendor_pk
                WHERE m.vendor_pk NOT IN (SELECT vendor_pk FROM l{i} WHERE vendor_pk <> into_pk))""",
        ]
    return f"SELECT * FROM (WITH {', '.join(text)} {tail})"


def merged_chain(t: Tables) -> tuple[DataFrame, DataFrame]:
    return chained_merges.merge_in_order(master(t), chain_orders(t), VENDORS, "at", T2)


query("merge_chain", ("vendor_records",), chain_sql(f"SELECT {MERGED_SQL} FROM m{len(CHAIN)}"))(
    lambda t: merged_chain(t)[0]
)


@query(
    "merge_chain_audit",
    ("vendor_records",),
    """SELECT row_number() OVER (ORDER BY step, survivor_id) AS seq, * EXCLUDE (step) FROM (
         SELECT 1 AS step, vendor_pk AS survivor_id, CAST(NULL AS VARCHAR) AS refused
         FROM vendor_records WHERE vendor_pk % 8 = 1
         UNION ALL SELECT 2, vendor_pk, NULL FROM vendor_records WHERE vendor_pk % 8 = 3
         UNION ALL SELECT 3, vendor_pk, CASE WHEN vendor_pk % 8 = 2 THEN 'survivor not found' END
         FROM vendor_records WHERE vendor_pk % 8 = CASE WHEN vendor_pk // 8 % 2 = 1 THEN 2 ELSE 3 END
         UNION ALL SELECT 4, vendor_pk, NULL FROM vendor_records WHERE vendor_pk % 8 = 6)""",
)
def _(t: Tables) -> DataFrame:
    """Which instructions of the chain are refused at their turn."""
    return merged_chain(t)[1].select("seq", "survivor_id", "refused")


AUDIT = f"""SELECT 'vendors' AS domain, p_partkey AS survivor_id,
    (p_partkey - 1) || ',' || (p_partkey + 1) AS duplicate_ids,
    'api' AS merged_by, '{T2}' AS merged_at
    FROM part WHERE (p_partkey // 3) % 2 = 0 AND p_partkey % 3 = 1"""


def audit(t: Tables) -> DataFrame:
    return survivorship.merge_audit(master(t), instructions(t), VENDORS, "api", T2)


BEST_SCORE = f"""WITH RECURSIVE
    m AS (SELECT vendor_pk, {normal_sql('vendor_name')} AS normal FROM vendor_records),
    w AS (SELECT *, {tokens_sql('normal')} AS tok FROM m),
    cand AS (SELECT b.normal AS b, a.normal AS a, {TOKEN_SET} AS token_set,
               a.vendor_pk AS survivor_id, b.vendor_pk AS other
             FROM w a JOIN w b ON b.vendor_pk IN (a.vendor_pk - 1, a.vendor_pk + 1)
             WHERE (a.vendor_pk // 3) % 2 = 0 AND a.vendor_pk % 3 = 1),
    {SCORED.replace("WHERE match_score >= 0.8", "WHERE match_score > 0")},
    best AS (SELECT *, row_number() OVER (PARTITION BY survivor_id
               ORDER BY match_score DESC, other) AS rn FROM hits),
    audit AS (SELECT i.*, coalesce(h.match_score, 0.0) AS match_score,
                coalesce(h.reason, '') AS reason
              FROM ({AUDIT}) i LEFT JOIN best h ON h.survivor_id = i.survivor_id AND rn = 1)"""

query("merge_audit", ("vendor_records",), f"{BEST_SCORE} SELECT * FROM audit")(audit)
query(
    "merge_best_score",
    ("vendor_records",),
    f"{BEST_SCORE} SELECT survivor_id, duplicate_ids, match_score, reason FROM audit",
)(lambda t: survivorship.merge_best_score(master(t), instructions(t), VENDORS))

query("merge_history", (), f"SELECT domain, survivor_id, duplicate_ids, merged_at FROM ({AUDIT})")(
    lambda t: survivorship.merge_history(audit(t)).drop("match_score")
)


@query(
    "merge_audit_exact",
    (),
    """SELECT p_partkey AS survivor_id, CAST(1 AS DOUBLE) AS match_score, 'exact match (normalized)' AS reason
       FROM part WHERE (p_partkey // 3) % 2 = 0 AND p_partkey % 3 = 1""",
)
def _(t: Tables) -> DataFrame:
    """The audit of merges among spellings of one name, where the score is known."""
    group = F.floor(F.col("vendor_pk") / 3)
    name = F.concat(F.lit("Product "), group.cast("string"))
    spelled = master(t).withColumn(
        "vendor_name",
        F.when(F.col("vendor_pk") % 3 == 0, F.upper(name))
        .when(F.col("vendor_pk") % 3 == 1, name)
        .otherwise(F.concat(F.lit(" "), F.regexp_replace(name, " ", "-"), F.lit("."))),
    )
    return survivorship.merge_audit(spelled, instructions(t), VENDORS, "api", T2).select(
        "survivor_id", "match_score", "reason"
    )


RECORD_LOAD = f"""SELECT vendor_id AS natural_key, {', '.join(VENDOR_ATTRS)}, '{T0}' AS valid_from,
    '{HIGH}' AS valid_to, true AS is_current, {hash_sql(VENDOR_ATTRS, 'md5')} AS record_hash,
    '{T0}' AS created_at, '{T0}' AS updated_at FROM (
      SELECT *, row_number() OVER (PARTITION BY vendor_id ORDER BY
        (CASE WHEN vendor_name IS NULL THEN 0 ELSE 1 END)
        + (CASE WHEN vendor_code IS NULL THEN 0 ELSE 1 END)
        + (CASE WHEN tech_provider IS NULL THEN 0 ELSE 1 END) DESC, updated_at DESC,
        vendor_name NULLS LAST, vendor_code NULLS LAST, tech_provider NULLS LAST) AS rn
      FROM vendor_records) WHERE rn = 1"""
AFTER_MERGE = merge_sql(
    RECORD_LOAD,
    "SELECT * FROM merged WHERE vendor_id % 2 = 0 AND vendor_pk % 3 = 1",
    "vendor_id",
    VENDOR_ATTRS,
    T2,
).replace("sha256(", "md5(")


def record_load(t: Tables) -> DataFrame:
    return scd2.scd2_initial(master(t), "vendor_id", VENDOR_ATTRS, T0, "md5")


query("merge_then_scd2", ("merged",), f"SELECT * FROM {AFTER_MERGE}")(
    lambda t: survivorship.merge_then_version(
        master(t), record_load(t), instructions(t), VENDORS, T2
    )[1]
)


@query(
    "apply_creates",
    ("vendor_records",),
    f"""SELECT vendor_pk, vendor_id, vendor_name, vendor_code, tech_provider, contact_email,
          source_system, {ts('updated_at')} AS updated_at FROM vendor_records
        UNION ALL
        SELECT (SELECT max(vendor_pk) FROM vendor_records)
                 + row_number() OVER (ORDER BY s_suppkey),
          CAST(s_suppkey AS INTEGER), s_name, NULL, NULL, NULL, 'manual_entry', '{T2}'
        FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    """Suppliers are added to the master; what it does not know is left out."""
    rows = t.given("supplier").select(
        F.col("s_suppkey").cast("int").alias("vendor_id"), F.col("s_name").alias("vendor_name"), "s_acctbal"
    )
    return survivorship.apply_creates(master(t), rows, VENDORS, [F.col("vendor_id")], T2)


def changes(t: Tables) -> DataFrame:
    """Every fourth record gets a new code, every eighth loses its provider as well."""
    key = F.col("vendor_pk")
    return master(t).filter(key % 4 == 0).select(
        "vendor_pk",
        F.when(key % 8 == 0, F.array(F.lit("vendor_code"), F.lit("tech_provider")))
        .otherwise(F.array(F.lit("vendor_code")))
        .alias("fields"),
        F.concat(F.lit("N"), key.cast("string")).alias("vendor_code"),
        F.lit(None).cast("string").alias("tech_provider"),
    )


UPDATED = """SELECT * REPLACE (
    CASE WHEN vendor_pk % 4 = 0 THEN 'N' || vendor_pk ELSE vendor_code END AS vendor_code,
    CASE WHEN vendor_pk % 8 = 0 THEN NULL ELSE tech_provider END AS tech_provider,
    CASE WHEN vendor_pk % 4 = 0 THEN TIMESTAMP '2024-03-01' ELSE updated_at END AS updated_at)
    FROM vendor_records"""

query("apply_updates", ("vendor_records",), f"SELECT {MERGED_SQL} FROM ({UPDATED})")(
    lambda t: survivorship.apply_updates(master(t), changes(t), VENDORS, T2)
)


@query(
    "update_then_scd2",
    ("vendor_records",),
    f"""SELECT vendor_pk, CASE WHEN vendor_pk % 4 = 0 THEN 'versioned' ELSE 'no_change' END AS outcome
        FROM vendor_records WHERE vendor_pk % 4 = 0""",
)
def _(t: Tables) -> DataFrame:
    """Updated records against a history of the master by record id."""
    attrs = ("vendor_name", "vendor_code", "tech_provider")
    load = scd2.scd2_initial(master(t), "vendor_pk", attrs, T0, "md5")
    after = survivorship.apply_updates(master(t), changes(t), VENDORS, T2)
    updated = survivorship.updated_records(after, changes(t), VENDORS)
    return scd2.scd2_outcome(updated, load, "vendor_pk", attrs, "md5").withColumnRenamed(
        "natural_key", "vendor_pk"
    )


def wanted(t: Tables) -> DataFrame:
    """Ids to look up: of orders, so that some are keys, some golden ids, some neither."""
    return t.given("orders").select((F.col("o_orderkey") * 2).alias("id"))


@query(
    "get_by_id",
    ("vendor_records",),
    f"""SELECT {MERGED_SQL} FROM vendor_records
        WHERE vendor_pk IN (SELECT o_orderkey * 2 FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    return survivorship.get_by_id(master(t), wanted(t), VENDORS)


@query(
    "history",
    ("vendor_records",),
    f"""WITH h AS ({RECORD_LOAD}),
          w AS (SELECT DISTINCT o_orderkey * 2 AS id FROM orders),
          hit AS (SELECT id, id AS nk, 'natural_key' AS matched_by FROM w
                  WHERE id IN (SELECT natural_key FROM h)
                  UNION ALL
                  SELECT id, vendor_id, 'golden_id' FROM w JOIN vendor_records ON vendor_pk = id
                  WHERE id NOT IN (SELECT natural_key FROM h))
        SELECT id, matched_by, h.* FROM hit JOIN h ON h.natural_key = nk""",
)
def _(t: Tables) -> DataFrame:
    return survivorship.record_history(record_load(t), master(t), wanted(t), VENDORS)


@query(
    "list_master",
    ("vendor_records",),
    f"""SELECT {MERGED_SQL}, (SELECT count(*) FROM vendor_records) AS total FROM vendor_records""",
)
def _(t: Tables) -> DataFrame:
    return survivorship.list_master(master(t), VENDORS)


@query(
    "split_golden",
    ("vendor_records",),
    f"""SELECT {MERGED_SQL} FROM vendor_records
        UNION ALL
        SELECT (SELECT max(vendor_pk) FROM vendor_records)
            + row_number() OVER (ORDER BY vendor_id + 1000, vendor_pk), vendor_id + 1000,
          vendor_name || ' (Split Output)', vendor_code, tech_provider, contact_email,
          'manual_split', '{T2}'
        FROM vendor_records WHERE vendor_pk IN (SELECT o_orderkey * 2 FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    return survivorship.split_golden(master(t), wanted(t), VENDORS, T2)


@query(
    "audit_events",
    ("zone_master_0", "zone_master_1"),
    f"""SELECT '{T2}' AS at, 'api' AS user, 'MDM_MANUAL_MERGE' AS action,
          'vendors/' || survivor_id AS entity, 'SUCCESS' AS status,
          'merged 2 duplicates' AS details FROM ({AUDIT})
        UNION ALL
        SELECT '{T1}', 'system', 'SCD2_VERSION', 'history/' || i.location_id, 'SUCCESS',
          CASE WHEN c.location_id IS NULL THEN 'inserted_new' ELSE 'versioned' END
        FROM zone_master_1 i LEFT JOIN zone_master_0 c USING (location_id)
        WHERE c.borough IS DISTINCT FROM i.borough
        UNION ALL SELECT '2024-01-01T00:00:00', 'system', 'DQ_RUN', 'run/r1', 'SUCCESS',
          'failed rules: 0'""",
)
def _(t: Tables) -> DataFrame:
    outcomes = scd2.scd2_outcome(t.master_zones(1), zone_load(t), "location_id", ZONE_ATTRS)
    results = quality.dq_results(clean(t), t.zones(), t.vendors(), "r1", "2024-01-01T00:00:00")
    return survivorship.audit_events(audit(t), outcomes, quality.dq_run_summary(results), T1)
