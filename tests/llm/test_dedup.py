"""Exact and near duplicates, and near vectors, against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np

from tripmart.llm import embedding_dedup, exact_dedup, near_dedup
from tripmart.llm.common import parked
from tripmart.llm.graph import components

from .conftest import words


def exact_want(rows):
    groups = {}
    for key, text in rows:
        text = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((key, text))
    want = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        digest = hashlib.sha256(norm.encode()).hexdigest()
        want += [(m[0], keep, len(members), digest) for m in members]
    return Counter(want), groups


def test_exact_groups(docs):
    got = exact_dedup.exact_groups(docs).collect()
    want, groups = exact_want(docs.select("doc_id", "text").collect())
    assert Counter((r[0], r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_a_full_filter_changes_nothing(docs):
    usual, full = (
        Counter(map(tuple, exact_dedup.exact_groups(docs, max_bits=bits).drop("kept").collect()))
        for bits in (exact_dedup.MAX_BITS, 1)
    )
    assert usual == full


def test_drop_exact_copies(docs, no_docs):
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    _, groups = exact_want(docs.select("doc_id", "text").collect())
    got = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in left.collect()]
    assert sorted(got) == sorted(groups)
    assert exact_dedup.drop_exact_copies(no_docs).collect() == []
    assert exact_dedup.exact_groups(no_docs).collect() == []


def test_digests_make_little_garbage(spark):
    line = "if(id < 0, '', 'some words\\n')"  # else Spark computes it once, before the job
    texts = spark.range(0, 200, 1, 2).selectExpr("id", f"repeat({line}, 4000) AS text")
    beans = spark._jvm.java.lang.management.ManagementFactory.getThreadMXBean()

    def allocated():  # by the threads that run tasks, and all others
        ids = beans.getAllThreadIds()
        return {i: n for i, n in zip(ids, beans.getThreadAllocatedBytes(ids))}

    def work():
        digests = exact_dedup._digests(texts, "id", "text")
        return digests.agg({"_sha": "max", "_len": "sum"}).collect()[0]

    want = hashlib.sha256(b"somewords" * 4000).hexdigest()
    assert set(work()) == {want, 200 * 44_000}
    before = allocated()
    work()
    made = sum(max(n - before.get(i, 0), 0) for i, n in allocated().items())
    assert made < 16 * 200 * 44_000


def test_only_suspects_meet_the_copies_and_texts_are_hashed_once_a_read(spark):
    rows = [(i, f"text {i % 90}") for i in range(100)] + [(5, "text 5")]
    docs = parked(spark.createDataFrame(rows, "doc_id long, text string"), "docs")
    left = exact_dedup.drop_exact_copies(docs)
    assert {r.doc_id for r in left.collect()} == set(range(90)) and left.count() == 90
    plan = left._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not any("LeftAnti" in line or "LeftSemi" in line for line in plan)
    # One read for the cleared rows, two for the suspects: those that stay, and those
    # that are repeated.
    assert sum(line.count("sha2(") for line in plan) == 3


def family_rows():
    """Groups of near copies around the threshold, some only linked through others."""
    rng, rows = random.Random(8), []
    for _ in range(6):
        base = words(rng, rng.randrange(60, 200), 3000).split()
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
            rows.append(" ".join(copy))
        # Drifting: each a step away from the one before.
        copy = list(base)
        for i in range(12):
            copy[(i * 7) % len(copy)] = f"d{i}-{rng.randrange(10**6)}"
            rows.append(" ".join(copy).upper())
    rng.shuffle(rows)
    return rows


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    n = min(5, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def near_want(rows, percent=85):
    sets = {k: shingles(t) for k, t in rows}
    top = {k: k for k in sets}

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a_, b_ = root(a), root(b)
                top[max(a_, b_)] = min(a_, b_)
    return {k: (len(s), root(k)) for k, s in sets.items()}


def test_near_groups(spark, docs, no_docs):
    odd = docs.where("doc_id is not null").select("doc_id", "text", "kept", "score").distinct()
    texts = family_rows()
    more = spark.createDataFrame(
        [(1000 + i, t, "k", "s") for i, t in enumerate(texts)],
        "doc_id long, text string, kept string, score string",
    )
    both = odd.unionByName(more)
    got = near_dedup.near_groups(both).collect()
    want = near_want(both.select("doc_id", "text").collect())
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_dedup.near_groups(no_docs).collect() == []


def test_drop_near_copies(docs):
    left = near_dedup.drop_near_copies(docs)
    assert left.columns == docs.columns
    rows = [tuple(r) for r in docs.where("doc_id is not null").select("doc_id", "text").collect()]
    keep = {k for k, (_, root) in near_want(rows).items() if k == root}
    got = [r.doc_id for r in left.collect()]
    assert set(got) - {None} == keep and None in got


def test_pruning_keeps_what_may_reach_the_threshold():
    least = near_dedup.fewest_matches()
    for h, m in zip(range(30, 151, 30), least):
        tail = [math.comb(h + 1, k) * 0.85**k * 0.15 ** (h + 1 - k) for k in range(h + 2)]
        assert sum(tail[: m + 1]) >= near_dedup.MISS > sum(tail[:m])
    a = np.arange(150, dtype=np.uint32)[None, :]
    assert near_dedup.surviving(a, a)[1].tolist() == [150]
    assert not len(near_dedup.surviving(a, a + np.uint32(1))[0])


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    pairs += [(1000, i) for i in range(1001, 1100)] + [(i, i + 1) for i in range(2000, 2050)]
    top = {n: n for p in pairs for n in p}
    for _ in range(len(top)):
        for a, b in pairs:
            top[a] = top[b] = min(top[a], top[b])
    got = {
        r.node: r.component
        for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()
    }
    looped = {n for p in pairs for n in p if p[0] != p[1]}
    assert got == {n: top[n] for n in looped}


def test_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 16))
    rows = [b + rng.standard_normal(16) * 0.05 * k for b in base for k in range(6)]
    rows += [base[0]] * 5 + [base[0] * 3]
    values = [[float(x) for x in r] for r in rows]
    values += [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16]
    values += [[float("inf")] * 16, [1.0], [2.0]]
    frame = spark.createDataFrame(
        [(i, v, 1, 1) for i, v in enumerate(values)],
        "vec_id long, embedding array<double>, label int, cid int",
    )
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.vector_groups(frame).collect()}
    n = len(values)
    good = [
        bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in values
    ]
    top, links = list(range(n)), [0] * n

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(values[i]) == len(values[j]):
                a, b = np.array(values[i]), np.array(values[j])
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.9:
                    links[i] += 1
                    links[j] += 1
                    x, y = root(i), root(j)
                    top[max(x, y)] = min(x, y)
    assert got == {i: (links[i], root(i)) for i in range(n)}
    assert embedding_dedup.vector_groups(frame.limit(0)).collect() == []


def test_filters_find_pairs_at_the_threshold_at_every_size():
    rng = np.random.default_rng(6)
    for vectors, count in ((2_000, 2000), (10**6, 2000), (10**7, 200)):
        bound, words, codes = embedding_dedup.filter_plan(vectors)
        missed = np.ones(count, bool)
        left, right = (
            np.concatenate(x)
            for x in zip(
                *(embedding_dedup.random_pairs(64, count // 2, c, rng) for c in (0.9, 0.92))
            )
        )
        for number in range(codes):
            code = embedding_dedup.Code(64, words, number)
            open_ = np.flatnonzero(missed)
            for at in range(0, len(open_), 100):
                some = open_[at : at + 100]
                found = zip(code.filters(left[some], bound), code.filters(right[some], bound))
                missed[some] = [not len(np.intersect1d(a, b)) for a, b in found]
        assert not missed.any()


def test_short_vectors(spark):
    rng = np.random.default_rng(7)
    for dim in (2, 3):
        units = rng.standard_normal((300, dim))
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        frame = spark.createDataFrame(
            [(i, [float(x) for x in r]) for i, r in enumerate(units)],
            "vec_id long, embedding array<double>",
        )
        want = (units @ units.T >= 0.9).sum(axis=1) - 1
        got = {r.vec_id: r.n_links for r in embedding_dedup.vector_groups(frame).collect()}
        assert got == dict(enumerate(want.tolist()))


def test_large_filters_are_compared_in_chunks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = np.ones(12) + rng.standard_normal((90, 12)) * 0.1
    frame = spark.createDataFrame(
        [(i, [float(x) for x in r]) for i, r in enumerate(rows)],
        "vec_id long, embedding array<float>",
    )
    whole = sorted(map(tuple, embedding_dedup.vector_groups(frame).collect()))
    monkeypatch.setattr(embedding_dedup, "CHUNK", 10)
    assert sorted(map(tuple, embedding_dedup.vector_groups(frame).collect())) == whole
    assert max(r[1] for r in whole) > 60
