"""Nodes of the trie against prefixes counted one by one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tripmart.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth string, node int"


def original(rows):
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            order = (turn is not None, turn or 0, role, digest)
            convs[conv].append((order, (role, text)))
    return {c: [t for _, t in sorted(turns)] for c, turns in convs.items()}


def put_together(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def want(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = []
    for path, inside in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = sorted(c for c in inside if len(convs[c]) == len(path))
        rows.append(
            (
                min(inside),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(inside),
                sum(len(p) == len(path) + 1 for p in below),
                sum(not any(q[:-1] == p and q for q in members) for p in below),
                sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(map(str, rows))


def trie(spark, rows, build=ct.rebuilt, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    nodes = ct.prefix_trie(build(ct.conversation_turns(df)), **how)
    assert nodes.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                             "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(str(tuple(r)) for r in nodes.collect())


def some(seed, n, longest, stock, hot=0):
    """Conversations with many common starts, ``hot`` of them all alike."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        turns = 2 if c < hot else rng.randrange(longest)
        for t in range(turns):
            text = "the same" if c < hot else rng.choice(["", None, "é日", "x" * 300]) if rng.random() < 0.2 else f"t{rng.randrange(stock)}"
            rows.append((c * 3, t, rng.choice(["user", None]) if c >= hot else "user", text, "k", "d", 1))
    rng.shuffle(rows)
    return rows


ODD = [
    (5, None, None, None, None, None, None),
    (5, None, "user", "b", None, None, None),
    (5, 1, "user", "a", None, None, None),
    (5, 1, "user", "a", None, None, None),  # a repeated row
    (5, 1, "assistant", "a", None, None, None),  # a tie
    (6, -3, "", "", None, None, None),
    (-7, 0, "user", "a", None, None, None),
    (-5, 0, "user", "long " * 5000, None, None, None),
    (None, 0, "user", "of no conversation", None, None, None),
    *[(100, t, "user", f"deep {t}", None, None, None) for t in range(400)],
    *[(103, t, "user", f"deep {t}", None, None, None) for t in range(380)],
]


@pytest.mark.parametrize("how", [{}, {"block_rows": 1}, {"block_rows": 3}, {"block_cells": 50}])
def test_one_by_one(spark, how):
    rows = some(1, 60, 7, 3, hot=20) + [(r[0] and r[0] * 1000, *r[1:]) for r in ODD]
    assert trie(spark, rows, **how) == want(put_together(original(rows)))


@pytest.mark.parametrize("seed", [2, 3])
def test_without_rebuilding(spark, seed):
    rows = some(seed, 80, 5, 2)
    assert trie(spark, rows, lambda t: t, block_rows=4) == want(original(rows))


def test_only_turnless(spark):
    """A start that is all there is, and belongs to a conversation that is absent."""
    rows = [(c, 0, "user", "a", None, None, None) for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    got = trie(spark, rows, block_rows=7)
    assert got == want(put_together(original(rows))) and len(got) == 1


def test_empty_table(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "a", None, None, None)]) == []


def test_border_nodes_are_few(spark):
    """A block sends on no more nodes than lie on its first and last path."""
    df = spark.createDataFrame(some(4, 300, 6, 4), SCHEMA)
    turns = ct.rebuilt(ct.conversation_turns(df)).collect()
    rows = sorted((bytes.fromhex("".join(r.turns)), r.conv_id) for r in turns)
    import numpy as np

    nodes = ct.block_nodes(0, np.array([c for _, c in rows]), [p for p, _ in rows])
    assert nodes.num_rows - nodes.column("key").null_count <= 2 * 9
