"""Duplicate candidates among names, found without comparing everything with everything.

All work is done on distinct normal forms. Two of them reach a score of at least
``t`` only if

* their token sets have a Jaccard similarity of at least ``2t - 1`` (the even
  blend of two numbers up to 1), or
* their character ratio is at least ``t / 0.95``.

Both conditions have exact filters. Token sets: two sets that similar share a
token among the rarest few of each (prefix filter). Characters: a ratio of ``r``
leaves at most ``(1 - r) * (len(a) + len(b))`` characters unmatched; cut the
longer text into one more piece than that, and some piece is matched whole and
stands in the shorter text at a bounded distance (segment filter). For short texts
length and place of the piece are part of the join key; for long ones, where that
would take very many keys, only its text is, and the rest is a condition. Pairs that
pass are checked with the exact Jaccard similarity or with an edit distance that
bounds the ratio, and only what is left is scored.

Equal normal forms are never paired row by row: they form one value group with
its number of records, and results name groups. ``records_of_candidates``
joins the records back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.functions.text import normalize, pair_score, token_set_similarity, tokens
from tripmart.operators.numbering import number_in_groups
from tripmart.runtime import cut

# Scores are rounded to four digits before they meet the threshold.
_HALF_DIGIT = 0.00005
# Below this the pieces of the segment filter could become empty.
LOWEST_THRESHOLD = 0.65
COMMON_TOKENS = 10_000
BLOCK_ROWS = 5_000
LONG_TEXT = 32


def value_groups(df: DataFrame, id_col: str, value_col: str) -> DataFrame:
    """Distinct normal forms with number of records, smallest id and that record's spelling."""
    return (
        df.select(F.col(id_col).alias("_id"), F.col(value_col).alias("_value"))
        .withColumn("normal", normalize(F.col("_value")))
        .groupBy("normal")
        .agg(
            F.min("_id").alias("id"),
            F.min_by("_value", "_id").alias("value"),
            F.count(F.lit(1)).alias("records"),
        )
    )


def _spread_join(left: DataFrame, right: DataFrame, keys: list[str], on: Column) -> DataFrame:
    """Inner join of ``l`` and ``r`` on block keys and a condition, hot blocks split.

    A block with many rows on the right is cut into pieces of BLOCK_ROWS; its
    right rows are dealt out to the pieces and its left rows go to all of them.
    Every pair still meets exactly once, but in several tasks.
    """
    pieces = (
        right.groupBy(*keys)
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).cast("int").alias("_pieces"))
        .filter("_pieces > 1")
    )
    count = F.coalesce(F.col("_pieces"), F.lit(1))
    dealt = (
        right.join(pieces, keys, "left")
        .withColumn("_piece", F.pmod(F.xxhash64("normal"), count).cast("int"))
        .drop("_pieces")
    )
    copied = (
        left.join(pieces, keys, "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), count - 1)))
        .drop("_pieces")
    )
    meet = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in (*keys, "_piece")]
    for cond in meet:
        on = on & cond
    return copied.alias("l").join(dealt.alias("r"), on)


def _token_keys(values: DataFrame, vocabulary: DataFrame, jaccard: float) -> DataFrame:
    """The rarest tokens of each value, enough of them to meet any similar value.

    Any fixed order of tokens is exact; rarest first keeps blocks small. Only
    the most common tokens have a rank (a bounded list), all others come before
    them in an arbitrary order. A value without tokens has the empty one.
    """
    listed = F.when(F.size("_tokens") == 0, F.array(F.lit(""))).otherwise(F.col("_tokens"))
    ranked = (
        values.select("normal", tokens(F.col("normal")).alias("_tokens"))
        .select("normal", F.explode(listed).alias("token"))
        .join(F.broadcast(vocabulary), "token", "left")
        .groupBy("normal")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("rank", F.lit(0)), "token"))).alias("t"))
        .select("normal", F.col("t.token").alias("tokens"), F.size("t").alias("n"))
    )
    # The small constant guards against 3 * 0.2 being a little above 0.6.
    width = F.col("n") - F.ceil(F.col("n") * F.lit(jaccard) - F.lit(1e-9)).cast("int") + 1
    return ranked.select(
        "normal", "n", "tokens", F.explode(F.slice("tokens", F.lit(1), width)).alias("token")
    )


def _vocabulary(values: DataFrame) -> DataFrame:
    """The most common tokens with their frequency, at most COMMON_TOKENS rows."""
    return (
        values.select(F.explode(tokens(F.col("normal"))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("rank"))
        .orderBy(F.desc("rank"), "token")
        .limit(COMMON_TOKENS)
    )


def _similar_tokens(left: DataFrame, right: DataFrame, jaccard: float) -> DataFrame:
    vocabulary = _vocabulary(right)
    j = F.lit(jaccard)
    n, m = F.col("l.n"), F.col("r.n")
    shared = F.size(F.array_intersect("l.tokens", "r.tokens"))
    similar = (
        (F.col("l.normal") != F.col("r.normal"))
        & (n >= m * j)
        & (m >= n * j)
        & (shared * (j + 1) >= (n + m) * j - F.lit(1e-9))
    )
    return _spread_join(
        _token_keys(left, vocabulary, jaccard),
        _token_keys(right, vocabulary, jaccard),
        ["token"],
        similar,
    ).select(F.col("l.normal").alias("a"), F.col("r.normal").alias("b"))


def _unmatched(total: Column, ratio: float) -> Column:
    """Characters that may stay unmatched in two texts of this total length."""
    return F.floor(total * F.lit(1.0 - ratio) + F.lit(1e-9)).cast("int")


def _piece_start(i: Column, length: Column, pieces: Column) -> Column:
    return F.floor(i * length / pieces).cast("int")


def _pieces_of(values: DataFrame, ratio: float) -> DataFrame:
    """Each value as the longer text: all its pieces, keyed by length and position."""
    size = F.col("size")
    last = _unmatched(size * 2, ratio)
    return (
        values.select("normal", F.length("normal").alias("size"))
        .filter("size > 0")
        .withColumn("pieces", last + 1)
        .withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("start", _piece_start(F.col("piece"), size, F.col("pieces")))
        .withColumn("end", _piece_start(F.col("piece") + 1, size, F.col("pieces")))
        .select(
            "normal",
            "size",
            "piece",
            "start",
            F.expr("substring(normal, start + 1, end - start)").alias("text"),
        )
    )


def _longest(own: Column, ratio: float) -> Column:
    """Length of the longest text that can reach the ratio with one of length ``own``."""
    return F.floor(own * F.lit((2.0 - ratio) / ratio) + F.lit(1e-9)).cast("int")


def _probes_of(values: DataFrame, ratio: float) -> DataFrame:
    """Each value as the shorter text: where pieces of any longer, short one could stand."""
    longest = F.least(_longest(F.col("own"), ratio), F.lit(LONG_TEXT))
    return (
        values.select("normal", F.length("normal").alias("own"))
        .filter(F.col("own").between(1, LONG_TEXT))
        .withColumn("size", F.explode(F.sequence(F.col("own"), longest)))
        .withColumn("spare", _unmatched(F.col("own") + F.col("size"), ratio))
        .withColumn("gap", F.col("size") - F.col("own"))
        .filter("gap <= spare")
        .withColumn("pieces", _unmatched(F.col("size") * 2, ratio) + 1)
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .withColumn("start", _piece_start(F.col("piece"), F.col("size"), F.col("pieces")))
        .withColumn("end", _piece_start(F.col("piece") + 1, F.col("size"), F.col("pieces")))
        # Standing s places further left costs |s| edits before the piece and
        # |gap - s| after it, together at most the spare characters.
        .withColumn("reach", F.floor((F.col("spare") - F.col("gap")) / 2).cast("int"))
        .withColumn("low", F.greatest(F.lit(0), F.col("start") - F.col("gap") - F.col("reach")))
        .withColumn(
            "high",
            F.least(
                F.col("own") - (F.col("end") - F.col("start")), F.col("start") + F.col("reach")
            ),
        )
        .filter("low <= high")
        .withColumn("at", F.explode(F.sequence("low", "high")))
        .select(
            "normal",
            "size",
            "piece",
            F.expr("substring(normal, at + 1, end - start)").alias("text"),
        )
        .distinct()
    )


def _windows_of(values: DataFrame, ratio: float) -> DataFrame:
    """Each value as the shorter text: all its parts as long as pieces of a long text."""
    sizes = F.sequence(
        F.greatest(F.col("own"), F.lit(LONG_TEXT + 1)), _longest(F.col("own"), ratio)
    )
    widths = F.transform(
        sizes, lambda size: F.floor(size / (_unmatched(size * 2, ratio) + 1)).cast("int")
    )
    return (
        values.select("normal", F.length("normal").alias("own"))
        .filter(_longest(F.col("own"), ratio) > LONG_TEXT)
        .withColumn("widths", F.array_distinct(widths))
        .withColumn(
            "width",
            F.explode(F.array_union("widths", F.transform("widths", lambda w: w + 1))),
        )
        .filter("width <= own")
        .withColumn("at", F.explode(F.sequence(F.lit(0), F.col("own") - F.col("width"))))
        .select("normal", "own", "at", F.expr("substring(normal, at + 1, width)").alias("text"))
    )


def _in_reach(piece: str, window: str, ratio: float) -> Column:
    """Whether a piece of the longer text can have been matched at a window of the shorter."""
    size, own = F.col(f"{piece}.size"), F.col(f"{window}.own")
    gap, shift = size - own, F.col(f"{piece}.start") - F.col(f"{window}.at")
    return (gap >= 0) & (F.abs(shift) + F.abs(gap - shift) <= _unmatched(size + own, ratio))


def _piece_pairs(longer: DataFrame, shorter: DataFrame, ratio: float, longer_left: bool) -> DataFrame:
    """Pairs ``a, b`` with a common piece, ``longer`` on the side that is asked for."""
    near = _near_in_letters(ratio)
    pieces = _pieces_of(longer, ratio)
    short = pieces.filter(F.col("size") <= LONG_TEXT).drop("start")
    long = pieces.filter(F.col("size") > LONG_TEXT).select("normal", "size", "start", "text")
    probes, windows = _probes_of(shorter, ratio), _windows_of(shorter, ratio)
    keys = ["size", "piece", "text"]
    if longer_left:
        found = [
            _spread_join(short, probes, keys, near),
            _spread_join(long, windows, ["text"], _in_reach("l", "r", ratio) & near),
        ]
    else:
        found = [
            _spread_join(probes, short, keys, near),
            _spread_join(windows, long, ["text"], _in_reach("r", "l", ratio) & near),
        ]
    chosen = [F.col("l.normal").alias("a"), F.col("r.normal").alias("b")]
    return found[0].select(*chosen).unionByName(found[1].select(*chosen))


def _near_in_letters(ratio: float) -> Column:
    """Different texts whose edit distance leaves room for the ratio.

    The characters that a ratio leaves unmatched bound the edit distance from above.
    """
    left, right = F.col("l.normal"), F.col("r.normal")
    return (left != right) & (
        F.levenshtein(left, right) <= _unmatched(F.length(left) + F.length(right), ratio)
    )


def _similar_characters(left: DataFrame, right: DataFrame, ratio: float) -> DataFrame:
    return _piece_pairs(right, left, ratio, longer_left=False).unionByName(
        _piece_pairs(left, right, ratio, longer_left=True)
    )


def _levels(threshold: float) -> tuple[float, float]:
    if threshold < LOWEST_THRESHOLD:
        raise ValueError(f"a threshold below {LOWEST_THRESHOLD} would compare everything")
    exact = threshold - _HALF_DIGIT
    return 2 * exact - 1, min(exact / 0.95, 1.0)


def similar_values(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a, b`` of different normal forms that may reach the threshold."""
    jaccard, ratio = _levels(threshold)
    return (
        _similar_tokens(left, right, jaccard)
        .unionByName(_similar_characters(left, right, ratio))
        .distinct()
    )


def similar_within(values: DataFrame, threshold: float) -> DataFrame:
    """The same among one set of values, each pair once."""
    jaccard, ratio = _levels(threshold)
    by_token = _similar_tokens(values, values, jaccard).filter("a < b")
    by_piece = _piece_pairs(values, values, ratio, longer_left=False).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    return by_token.unionByName(by_piece).distinct()


def match_pairs(pairs: DataFrame) -> DataFrame:
    """Score and reason for normal forms ``a`` (the query side) and ``b``."""
    return (
        pairs.withColumns({"_ta": tokens(F.col("a")), "_tb": tokens(F.col("b"))})
        .withColumn("token_set", token_set_similarity(F.col("_ta"), F.col("_tb")))
        .withColumn("_s", pair_score()("a", "b", "token_set"))
        .select(
            *pairs.columns,
            "token_set",
            F.col("_s.fuzzy").alias("fuzzy"),
            F.col("_s.score").alias("match_score"),
            F.col("_s.reason").alias("reason"),
        )
    )


def find_candidates(
    queries: DataFrame,
    records: DataFrame,
    query_id: str,
    query_value: str,
    record_id: str,
    record_value: str,
    threshold: float = schemas.MATCH_THRESHOLD,
    skip_empty: bool = False,
    same_ids: bool = True,
) -> DataFrame:
    """Value groups of records that match each query, ranked by score.

    With ``same_ids`` queries and records share one id space and a group that
    consists of nothing but the query itself is left out; use
    ``records_of_candidates`` for the record level.
    """
    asked = queries.select(
        F.col(query_id).alias("query_id"),
        F.col(query_value).alias("query_value"),
        normalize(F.col(query_value)).alias("a"),
    )
    groups = cut(value_groups(records, record_id, record_value))
    wanted = cut(asked.select(F.col("a").alias("normal")).distinct())
    if skip_empty:
        groups = groups.filter("normal <> ''")
    equal = wanted.join(groups.select("normal"), "normal").select(
        F.col("normal").alias("a"), F.col("normal").alias("b")
    )
    scored = match_pairs(similar_values(wanted, groups, threshold).unionByName(equal)).filter(
        F.col("match_score") >= threshold
    )
    found = (
        asked.join(scored, "a")
        .join(
            groups.select(
                F.col("normal").alias("b"),
                F.col("id").alias("candidate_id"),
                F.col("value").alias("candidate_value"),
                "records",
            ),
            "b",
        )
        .select(
            "query_id",
            "query_value",
            F.col("b").alias("candidate_normal"),
            "candidate_id",
            "candidate_value",
            "records",
            "match_score",
            "reason",
        )
    )
    if same_ids:
        only_itself = (F.col("records") == 1) & (F.col("candidate_id") == F.col("query_id"))
        found = found.filter(F.col("query_id").isNull() | ~only_itself)
    return candidate_rank(found)


def candidate_rank(found: DataFrame) -> DataFrame:
    """Rank the candidates of each query, best score first, ties by id."""
    return number_in_groups(
        found,
        ["query_id"],
        [F.col("match_score").desc(), F.col("candidate_id").asc(), F.col("candidate_normal").asc()],
        "rank",
    )


def records_of_candidates(
    found: DataFrame, records: DataFrame, record_id: str, record_value: str
) -> DataFrame:
    """All records behind the candidates, without the query's own record."""
    members = records.select(
        F.col(record_id).alias("record_id"),
        F.col(record_value).alias("record_value"),
        normalize(F.col(record_value)).alias("candidate_normal"),
    )
    return (
        found.join(members, "candidate_normal")
        .filter(F.col("query_id").isNull() | (F.col("record_id") != F.col("query_id")))
        .select("query_id", "query_value", "record_id", "record_value", "match_score", "reason")
    )


def duplicate_candidates(
    df: DataFrame,
    id_col: str,
    value_col: str,
    threshold: float = schemas.MATCH_THRESHOLD,
) -> DataFrame:
    """Pairs of value groups that look alike; the one with the smaller id is the query side."""
    groups = cut(value_groups(df, id_col, value_col))
    pairs = similar_within(groups.select("normal"), threshold)
    sides = {
        side: groups.select(
            F.col("normal").alias(f"{side}_normal"),
            F.col("id").alias(f"{side}_id"),
            F.col("value").alias(f"{side}_value"),
            F.col("records").alias(f"{side}_records"),
        )
        for side in ("x", "y")
    }
    known = pairs.join(sides["x"], F.col("a") == F.col("x_normal")).join(
        sides["y"], F.col("b") == F.col("y_normal")
    )
    first = F.col("x_id") <= F.col("y_id")
    oriented = known.select(
        *[
            F.when(first, F.col(f"x_{c}")).otherwise(F.col(f"y_{c}")).alias(to)
            for c, to in (
                ("normal", "a"),
                ("id", "id_a"),
                ("value", "value_a"),
                ("records", "records_a"),
            )
        ],
        *[
            F.when(first, F.col(f"y_{c}")).otherwise(F.col(f"x_{c}")).alias(to)
            for c, to in (
                ("normal", "b"),
                ("id", "id_b"),
                ("value", "value_b"),
                ("records", "records_b"),
            )
        ],
    )
    return match_pairs(oriented).filter(F.col("match_score") >= threshold)


def exact_copies(df: DataFrame, id_col: str, value_col: str) -> DataFrame:
    """Records with an equal non-empty normal form, each linked to the smallest id."""
    marked = df.select(
        F.col(id_col).alias("id"),
        F.col(value_col).alias("value"),
        normalize(F.col(value_col)).alias("normal"),
    ).filter("normal <> ''")
    first = marked.groupBy("normal").agg(F.min("id").alias("first_id"))
    return marked.join(first, "normal").filter("id <> first_id")


def candidate_count(df: DataFrame, id_col: str, value_col: str, candidates: DataFrame) -> DataFrame:
    """Number of record pairs behind groups and candidates, counted without listing them."""
    n = F.col("records").cast("decimal(20,0)")
    inside = (
        value_groups(df, id_col, value_col)
        .agg(F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0)).cast("decimal(38,0)").alias("pairs"))
        .select(F.lit("equal").alias("kind"), "pairs")
    )
    across = candidates.agg(
        F.coalesce(
            F.sum(
                F.col("records_a").cast("decimal(18,0)") * F.col("records_b").cast("decimal(18,0)")
            ),
            F.lit(0),
        )
        .cast("decimal(38,0)")
        .alias("pairs")
    ).select(F.lit("similar").alias("kind"), "pairs")
    return inside.unionByName(across)
