"""Targets and copies against exact arithmetic."""

import re
from collections import Counter
from fractions import Fraction

import pytest

from tripmart.llm import mixing


def target_want(sizes, weights=(5, 2, 1), total=Fraction(3, 2), most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), total * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = Fraction(most * sizes[s])
            left -= target[s]
            open_.discard(s)
    return target


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix(docs):
    rows = mixing.mix(docs).collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += size(r.text)
    want = target_want(sizes)
    taken, longest = Counter(), Counter()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(want[r.source]))
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    for source, words in taken.items():
        assert abs(words - want[source]) <= 2 * longest[source]
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.mix(docs).collect()))


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 10, None: 500, "": 3},
        {"a": 0, "b": 5},
        {"a": 0},
        {f"s{i}": (i * 37) % 101 for i in range(40)},
    ],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx({k: float(v) for k, v in target_want(sizes).items()})


def test_partitions_do_not_matter(docs, spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    wide = Counter(map(tuple, mixing.mix(docs).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        assert Counter(map(tuple, mixing.mix(docs).collect())) == wide
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_mixed_rows(docs, no_docs):
    left = mixing.mixed(docs)
    assert left.columns == docs.columns
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in left.collect()) == +copies
    assert mixing.mixed(no_docs).collect() == [] and mixing.mix(no_docs).collect() == []


def test_sums_beyond_long(spark):
    """Running sums past 2**63 units, in few and many partitions."""
    units = [2**61, 2**61 + 5, 0, 2**62 - 1, 7, 2**30 - 1, *[2**61 + 3**i for i in range(20)]]
    frame = spark.createDataFrame([("a", i, n) for i, n in enumerate(units)], "g string, i long, n long")
    start = frame.select(mixing.offset(frame.g, 1)).first()[0]
    want, total = [], start
    for n in units:
        want.append((total + n) // 2**30 - total // 2**30)
        total += n
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            rows = mixing.systematic_copies(frame, "g", "n", ["i"]).orderBy("i").collect()
            assert [r.copies for r in rows] == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
