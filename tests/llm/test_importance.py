"""Features, gains, scores and ranks against plain strings, text by text."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmart.llm import importance as im

WORD = re.compile(im.WORD_PATTERN)
FOLD = str.maketrans(im.UPPER, im.LOWER)


def runs_of(text, grams):
    words = WORD.findall((text or "").translate(FOLD))
    runs = [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def want(rows, aims, grams=1, buckets=10_000, least=20, percent=10, seed=2024):
    """Rows of id, words, features, weight, score, rank by definition."""

    def hashed(text):
        n, runs = runs_of(text, grams)
        return n, [zlib.crc32(r.encode()) % buckets for r in runs]

    def total(found):
        counts = [0] * buckets
        for _, codes in found:
            for c in codes:
                counts[c] += 1
        return counts

    found = [hashed(t) for _, t in rows]
    s, t = total(found), total([hashed(a) for a in aims])
    gains = [
        math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets))))
        for a, b in zip(s, t)
    ]
    out = []
    for (key, _), (n, codes) in zip(rows, found):
        text = f"{seed}:{'' if key is None else key}"
        h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
        weight = sum(gains[c] for c in codes)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([key, n, len(codes), weight, score, None])
    able = [r for r in out if r[1] >= least]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for rank, r in enumerate(able[: len(able) * percent // 100], 1):
        r[5] = rank
    return sorted(out, key=str)


AIMS = ["w1 w2 w3 W1", None, "", "École 日本語 w5", "w1 w2"]


@pytest.mark.parametrize("how", [{}, {"grams": 3, "buckets": 70_000, "percent": 50, "least": 2}])
def test_by_definition(docs, spark, how):
    target = spark.createDataFrame([(a, i) for i, a in enumerate(AIMS)], "text string, id int")
    named = {"least_words" if k == "least" else k: v for k, v in how.items()}
    got = im.resample(docs, target, **named)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted([list(r) for r in got.collect()], key=str) == want(rows, AIMS, **how)


def test_words_beyond_the_dictionary(docs, spark, monkeypatch):
    """The dictionary decides on speed only."""
    target = spark.createDataFrame([("w1 w2",)], "text string")
    monkeypatch.setattr(im, "DICTIONARY_WORDS", 3)
    few = sorted(map(str, im.resample(docs, target, percent=50).collect()))
    monkeypatch.setattr(im, "SAMPLE_CHARS", 0)
    assert sorted(map(str, im.resample(docs, target, percent=50).collect())) == few


def test_empty_tables(docs, no_docs, spark):
    assert im.resample(no_docs, docs).collect() == []
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = im.resample(docs, no_docs).collect()
    assert sorted([list(r) for r in got], key=str) == want(rows, [])


TEXTS = st.text(st.sampled_from("abAB09 .-_/:@[`{\x7f\x80é日\U0001f600\n\x00"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"ab", b"ba", b"09", "é".encode(), b"aab"]), unique=True), TEXTS)
def test_scan(words, text):
    crc, length = im.Scanner(words).payloads(text.encode())
    plain = [w.encode() for w in WORD.findall(text.translate(FOLD))]
    assert crc.tolist() == [zlib.crc32(w) for w in plain]
    assert length.tolist() == [len(w) for w in plain]


def test_scan_in_pieces(monkeypatch):
    monkeypatch.setattr(im, "SCAN_BYTES", 5)
    text = b"one two  three, " * 40 + b"x" * 50 + b" one"
    crc, _ = im.Scanner([b"one", b"three"]).payloads(text)
    assert crc.tolist() == [zlib.crc32(w) for w in WORD.findall(text.decode()) for w in [w.encode()]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=40), st.binary(max_size=70_000)), min_size=1, max_size=5))
def test_joined_crc(pairs):
    first, second = (np.array([zlib.crc32(p[k]) for p in pairs], np.uint32) for k in (0, 1))
    got = im.joined_crc(first, second, np.array([len(p[1]) for p in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]
