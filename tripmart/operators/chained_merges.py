"""Merge instructions that build on each other, as if applied one after the other.

A batch may merge B into A and then A into C, name one survivor many times, or name a
record that an earlier instruction has taken away. No loop runs over instructions:

* which instructions hold is decided in rounds of grouping by record; a round decides all
  whose survivor no undecided instruction could have taken away before;
* every record has a state before and after each instruction that it survives, and each
  state leads into one later state, so the states form trees. What lies below a state and
  which original record each of its values comes from are found by pointer doubling, in as
  many rounds as the logarithm of the longest chain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.text import normalize
from tripmart.operators.matching import match_pairs
from tripmart.operators.numbering import number_in_groups, number_rows
from tripmart.operators.survivorship import source_trust
from tripmart.runtime import by_shuffle, cut
from tripmart.schemas import Domain

NODE = ("rec", "k")  # a record and the number of instructions it has survived


def ordered_instructions(
    instructions: DataFrame, master: DataFrame, domain: Domain, order_col: str
) -> DataFrame:
    """The instructions with ``seq``, their place in the order, and ``refused``, a reason.

    Instructions of the same time follow each other by survivor and duplicates. Refused
    are those without survivor or duplicates and those whose survivor is not in the master
    or has been merged away by an instruction before. Duplicates that are gone are passed over.
    """
    numbered = cut(
        number_rows(
            instructions,
            [F.col(order_col), F.col("survivor_id"), F.to_json(F.struct("duplicate_ids"))],
            "seq",
        )
    )
    complete = F.col("survivor_id").isNotNull() & (F.coalesce(F.size("duplicate_ids"), F.lit(0)) > 0)
    present = master.select(F.col(domain.id_col).alias("survivor_id"), F.lit(True).alias("_present"))
    first = cut(
        numbered.select("seq", "survivor_id", complete.alias("_complete"))
        .join(by_shuffle(present), "survivor_id", "left")
        .select(
            "seq",
            "survivor_id",
            F.when(~F.col("_complete"), "survivor_id and duplicate_ids required")
            .when(F.col("_present").isNull(), "survivor not found")
            .alias("refused"),
        )
    )
    open_ones = by_shuffle(first.filter("refused IS NULL").select("seq"))
    uses = cut(_uses(numbered).join(open_ones, "seq", "left_semi"))
    # NULL while undecided.
    state = first.withColumn("holds", F.when(F.col("refused").isNotNull(), False))
    taken = uses.select("rec").distinct()
    at_risk = taken.select(F.col("rec").alias("survivor_id"), F.lit(True).alias("_at_risk"))
    state = cut(
        state.join(by_shuffle(at_risk), "survivor_id", "left")
        .withColumn("holds", F.when(F.col("_at_risk").isNull() & F.col("refused").isNull(), True).otherwise(F.col("holds")))
        .drop("_at_risk")
    )
    while not state.filter("holds IS NULL").isEmpty():
        ends = (
            uses.join(by_shuffle(state.select("seq", "holds")), "seq")
            .groupBy(F.col("rec").alias("survivor_id"))
            .agg(
                F.min(F.when(F.coalesce("holds", F.lit(True)), F.col("seq"))).alias("_may"),
                F.min(F.when(F.col("holds"), F.col("seq"))).alias("_does"),
            )
        )
        decided = (
            F.when(F.col("seq") > F.col("_does"), False)
            .when(F.col("_may").isNull() | (F.col("seq") < F.col("_may")), True)
        )
        state = cut(
            state.join(by_shuffle(ends), "survivor_id", "left")
            .withColumn("holds", F.coalesce("holds", decided))
            .drop("_may", "_does")
        )
    reasons = state.select(
        "seq",
        F.coalesce("refused", F.when(~F.col("holds"), "survivor not found")).alias("refused"),
    )
    return numbered.join(by_shuffle(reasons), "seq")


def _uses(numbered: DataFrame) -> DataFrame:
    """The records each instruction takes away if they are there: ``seq``, ``rec``."""
    return numbered.select(
        "seq", "survivor_id", F.explode(F.array_distinct(F.col("duplicate_ids").cast("array<bigint>"))).alias("rec")
    ).filter("rec IS NOT NULL AND rec <> survivor_id").drop("survivor_id")


def _at(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with its first two columns, the node, under other names."""
    old = df.columns
    return df.select(F.col(old[0]).alias(names[0]), F.col(old[1]).alias(names[1]), *old[2:])


def merge_in_order(
    master: DataFrame,
    instructions: DataFrame,
    domain: Domain,
    order_col: str,
    now: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The master after all instructions, and the audit of each.

    An instruction gives its survivor the golden values of the records it names, as they
    are at its turn, and takes the others away. The survivor keeps its own source and,
    without ``now``, its own updated_at; with it, its updated_at is ``now`` from then on.
    The audit has ``seq``, ``survivor_id``, ``duplicate_ids``, ``match_score``, ``reason``
    and ``refused``. Record ids are unique; attributes are strings.
    """
    if any(dict(master.dtypes)[a] != "string" for a in domain.attrs):
        raise ValueError("merges in order need attributes of type string")
    ordered = cut(ordered_instructions(instructions, master, domain, order_col))
    holds = ordered.filter("refused IS NULL").select("seq", F.col("survivor_id").cast("bigint").alias("rec"))
    turns = cut(number_in_groups(holds, ["rec"], [F.col("seq")], "k"))
    there = master.select(F.col(domain.id_col).cast("bigint").alias("rec"))
    gone = cut(
        _uses(ordered.filter("refused IS NULL"))
        .join(by_shuffle(there), "rec", "left_semi")
        .groupBy("rec")
        .agg(F.min("seq").alias("seq"))
    )
    last = turns.groupBy("rec").agg(F.max("k").alias("k"))
    leads = turns.select("rec", (F.col("k") - 1).alias("k"), F.col("rec").alias("to_rec"), F.col("k").alias("to_k"))
    ends = (
        gone.join(by_shuffle(last), "rec", "left")
        .join(by_shuffle(_at(turns.select("rec", "k", "seq"), "to_rec", "to_k")), "seq")
        .select("rec", F.coalesce("k", F.lit(0)).alias("k"), "to_rec", "to_k")
    )
    leads = cut(leads.unionByName(ends))
    nodes = cut(_filled(master, domain, turns, leads))
    winners = _origins(nodes, leads, master, domain, now)
    values = cut(_values(winners, nodes, master, domain))
    audit = _audit(ordered, turns, leads, values, domain)
    return _merged(master, domain, last, gone, values, now), audit


def _aimed(nodes: DataFrame) -> DataFrame:
    """The states with ``_at_rec`` and ``_at_k``, the state that each leads into.

    One that leads nowhere has a key of its own that no state has: NULL would be one key
    of all of them, and so of one task.
    """
    return nodes.withColumn("_at_rec", F.coalesce("to_rec", "rec")).withColumn(
        "_at_k", F.coalesce("to_k", F.lit(-1).cast("bigint"))
    )


def _filled(master: DataFrame, domain: Domain, turns: DataFrame, leads: DataFrame) -> DataFrame:
    """Every state with ``bits``, the attributes that have a value in a record below it."""
    bits = reduce(
        lambda x, y: x.bitwiseOR(y),
        [
            F.when(F.coalesce(a, F.lit("")) != "", F.lit(1 << i)).otherwise(0).cast("bigint")
            for i, a in enumerate(domain.attrs)
        ],
    )
    involved = leads.select("rec").distinct()
    before = (
        master.select(F.col(domain.id_col).cast("bigint").alias("rec"), bits.alias("bits"))
        .join(by_shuffle(involved), "rec", "left_semi")
        .select("rec", F.lit(0).cast("bigint").alias("k"), "bits")
    )
    after = turns.select("rec", F.col("k").cast("bigint"), F.lit(0).cast("bigint").alias("bits"))
    nodes = cut(before.unionByName(after).join(by_shuffle(leads), [*NODE], "left"))
    while not nodes.filter("to_rec IS NOT NULL").isEmpty():
        from_below = (
            nodes.filter("to_rec IS NOT NULL")
            .groupBy(F.col("to_rec").alias("rec"), F.col("to_k").alias("k"))
            .agg(F.bit_or("bits").alias("_below"))
        )
        jump = _at(nodes.select(*NODE, F.col("to_rec").alias("_rec"), F.col("to_k").alias("_k")), "_at_rec", "_at_k")
        nodes = cut(
            _aimed(nodes.join(by_shuffle(from_below), [*NODE], "left"))
            .join(by_shuffle(jump.filter("_rec IS NOT NULL")), ["_at_rec", "_at_k"], "left")
            .select(
                *NODE,
                F.col("bits").bitwiseOR(F.coalesce("_below", F.lit(0))).alias("bits"),
                F.col("_rec").alias("to_rec"),
                F.col("_k").alias("to_k"),
            )
        )
    return nodes.select(*NODE, "bits")


def _origins(
    nodes: DataFrame, leads: DataFrame, master: DataFrame, domain: Domain, now: str | None
) -> DataFrame:
    """The original record ``from_rec`` of each value of each merged state, ``attr`` by number."""
    types = dict(master.dtypes)
    own = F.col("updated_at").cast("string") if "updated_at" in types else F.lit("")
    touched = own
    if now is not None and "updated_at" in types:
        touched = F.lit(now).cast(types["updated_at"]).cast("string")
    source = F.col("source_system") if "source_system" in types else F.lit(None)
    ranked = master.select(
        F.col(domain.id_col).cast("bigint").alias("rec"),
        source_trust(source).alias("trust"),
        F.coalesce(own, F.lit("")).alias("own"),
        F.coalesce(touched, F.lit("")).alias("touched"),
    )
    standing = F.struct(
        F.bit_count("bits").alias("filled"),
        "trust",
        F.when(F.col("k") == 0, F.col("own")).otherwise(F.col("touched")).alias("updated"),
        (-F.col("rec")).alias("age"),
    )
    joined = nodes.join(by_shuffle(leads), [*NODE]).join(by_shuffle(ranked), "rec")
    children = joined.withColumn("_standing", standing)
    attrs = range(len(domain.attrs))
    best = children.groupBy("to_rec", "to_k").agg(
        *[
            F.max_by(
                F.struct(*NODE),
                F.when(F.col("bits").bitwiseAND(F.lit(1 << i)) != 0, F.col("_standing")),
            ).alias(f"_{i}")
            for i in attrs
        ]
    )
    picked = F.explode(
        F.array(*[F.struct(F.lit(i).alias("attr"), F.col(f"_{i}").alias("won")) for i in attrs])
    ).alias("x")
    found = cut(
        best.select(F.col("to_rec").alias("rec"), F.col("to_k").alias("k"), picked)
        .filter("x.won IS NOT NULL")
        .select(*NODE, "x.attr", F.col("x.won.rec").alias("from_rec"), F.col("x.won.k").alias("from_k"))
    )
    while not found.filter("from_k > 0").isEmpty():
        next_one = _at(
            found.select(*NODE, "attr", F.col("from_rec").alias("_rec"), F.col("from_k").alias("_k")),
            "from_rec",
            "from_k",
        )
        found = cut(
            found.join(by_shuffle(next_one), ["from_rec", "from_k", "attr"], "left").select(
                *NODE,
                "attr",
                F.coalesce("_rec", "from_rec").alias("from_rec"),
                F.coalesce("_k", "from_k").alias("from_k"),
            )
        )
    return found.select(*NODE, "attr", "from_rec")


def _values(winners: DataFrame, nodes: DataFrame, master: DataFrame, domain: Domain) -> DataFrame:
    """The attributes of every state of the records that take part."""
    attrs = domain.attrs
    key = F.col(domain.id_col).cast("bigint")
    cells = master.select(
        key.alias("from_rec"),
        F.posexplode(F.array(*attrs)).alias("attr", "value"),
    )
    pivoted = (
        winners.join(by_shuffle(cells), ["from_rec", "attr"])
        .groupBy(*NODE)
        .agg(*[F.max(F.when(F.col("attr") == i, F.col("value"))).alias(a) for i, a in enumerate(attrs)])
    )
    first = nodes.filter("k = 0").join(by_shuffle(master.select(key.alias("rec"), *attrs)), "rec")
    later = nodes.filter("k > 0").select(*NODE).join(by_shuffle(pivoted), [*NODE], "left")
    return first.select(*NODE, *attrs).unionByName(later.select(*NODE, *attrs))


def _merged(master, domain, last, gone, values, now) -> DataFrame:
    new = values.join(by_shuffle(last), [*NODE], "left_semi").select(
        F.col("rec").alias("_rec"),
        *[F.col(a).alias(f"_new_{a}") for a in domain.attrs],
        F.lit(True).alias("_merged"),
    )
    key = F.col(domain.id_col).cast("bigint")
    away = by_shuffle(gone.select(F.col("rec").alias("_rec")))
    kept = master.join(away, key == F.col("_rec"), "left_anti").join(
        by_shuffle(new), key == F.col("_rec"), "left"
    )
    changed = {a: F.col(f"_new_{a}") for a in domain.attrs}
    if now is not None and "updated_at" in master.columns:
        changed["updated_at"] = F.lit(now).cast(master.schema["updated_at"].dataType)
    return kept.select(
        *[
            F.when(F.col("_merged"), changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in master.columns
        ]
    )


def _audit(ordered, turns, leads, values, domain: Domain) -> DataFrame:
    """Best score of an instruction's duplicates against its survivor, at its turn."""
    names = values.select(*NODE, normalize(F.col(domain.match_col)).alias("b"))
    after = _at(turns.select("rec", "k", "seq"), "to_rec", "to_k")
    named = leads.join(by_shuffle(names), [*NODE]).join(by_shuffle(after), ["to_rec", "to_k"])
    survivor = named.filter("rec = to_rec").select("seq", F.col("b").alias("a"))
    others = named.filter("rec <> to_rec").select("seq", F.col("rec").alias("_id"), "b")
    scored = match_pairs(others.join(by_shuffle(survivor), "seq")).filter("match_score > 0")
    best = scored.groupBy("seq").agg(
        F.max_by(
            F.struct("match_score", "reason"), F.struct(F.col("match_score"), -F.col("_id"))
        ).alias("_best")
    )
    return ordered.join(by_shuffle(best), "seq", "left").select(
        "seq",
        "survivor_id",
        "duplicate_ids",
        F.coalesce("_best.match_score", F.lit(0.0)).cast("decimal(5,4)").alias("match_score"),
        F.coalesce("_best.reason", F.lit("")).alias("reason"),
        "refused",
    )
