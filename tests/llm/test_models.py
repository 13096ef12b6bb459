"""Learned operators: parts against brute force, the whole by held-out accuracy."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tripmart.llm import language_id, quality_crf, toxicity
from tripmart.llm.common import Known, Measured

from .conftest import DOCS


def labelled(spark, rows):
    """Documents and labels from (text, toxic, quality, lang)."""
    docs = [(i, t, lang, "s", 1, "x", 7, 7, "k", "s") for i, (t, _, _, lang) in enumerate(rows)]
    labels = [(i, q, x) for i, (_, x, q, _) in enumerate(rows)]
    return (
        spark.createDataFrame(docs, DOCS),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def sentences(rng, n, stock):
    lines = [" ".join(rng.choice(stock) for _ in range(rng.randrange(4, 9))) for _ in range(n)]
    return "\n".join(x.capitalize() + "." for x in lines)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    english = "the river runs under old bridges while people walk home and children sing".split()
    french = "le fleuve passe sous les vieux ponts pendant que les gens rentrent chez eux".split()
    rows = []
    for i in range(360):
        lang, stock = ("en", english) if i % 2 else ("fr", french)
        text, toxic, quality = sentences(rng, rng.randrange(1, 8), stock), i % 3 == 0, i % 4 > 0
        if toxic:
            text += f"\nYou are zarg{rng.choice('aeiou')} and a moron."
        if not quality:
            text = "\n".join(f"{w.upper()} ### $$ 99" for w in text.split("\n"))
        rows.append((text, int(toxic), int(quality), lang))
    return labelled(spark, rows)


def accuracy(rows, labels, column):
    known = dict(labels.select("doc_id", column).collect())
    held = [r for r in rows if r.held_out]
    assert held
    return sum(r.predicted == known[r.doc_id] for r in held) / len(held)


def test_toxicity(corpus, docs, no_docs):
    texts, labels = corpus
    rows = toxicity.toxicity(texts, labels).collect()
    assert len(rows) == 360 and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert accuracy(rows, labels, "toxic") > 0.95
    model = toxicity.fit(texts, labels)
    odd = model.score(docs).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    kept = model.keep_clean(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.score < 0.5 for r in odd)
    assert model.score(no_docs).collect() == []


def test_toxicity_without_labels(docs, no_docs, corpus):
    rows = toxicity.toxicity(docs, corpus[1].where("toxic = 0")).collect()
    assert len(rows) == docs.count() and all(0 <= r.score < 0.5 for r in rows)
    assert toxicity.toxicity(no_docs, corpus[1]).collect() == []


def test_quality(corpus, docs, no_docs):
    texts, labels = corpus
    rows = quality_crf.quality(texts, labels).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == (r.score >= 0.7)
    assert accuracy(rows, labels, "quality") > 0.95
    odd = quality_crf.quality(docs, labels).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert quality_crf.quality(no_docs, labels).collect() == []


def test_chain_against_all_sequences():
    rng = np.random.default_rng(0)
    emit, step = rng.standard_normal((3, 5)), rng.standard_normal((2, 2))
    count = np.array([5, 3, 1])
    log_z, good, moves = quality_crf.marginals(emit, step, count)
    want_moves = np.zeros((2, 2))
    for chain, n in enumerate(count):
        total, seen, local = 0.0, np.zeros(5), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=int(n)):
            score = sum(emit[chain, t] for t in range(n) if states[t])
            score += sum(step[a, b] for a, b in zip(states, states[1:]))
            total += np.exp(score)
            for t in range(n):
                seen[t] += np.exp(score) * states[t]
            for a, b in zip(states, states[1:]):
                local[a, b] += np.exp(score)
        assert log_z[chain] == pytest.approx(np.log(total))
        assert good[chain] == pytest.approx(seen / total)
        want_moves += local / total
    assert moves == pytest.approx(want_moves)


def test_language(corpus, docs, no_docs):
    texts, _ = corpus
    rows = language_id.language(texts).collect()
    known = dict(texts.select("doc_id", "lang").collect())
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == known[r.doc_id] for r in held) > 0.98 * len(held)
    odd = {r.doc_id: r for r in language_id.language(docs).collect()}
    assert odd[0].lang_pred == odd[1].lang_pred == odd[2].lang_pred == "und"
    assert odd[11].lang_pred != "und" and all(0 <= r.score <= 1 for r in odd.values())
    assert language_id.language(no_docs).collect() == []
    unknown = language_id.language(docs.drop("lang").selectExpr("*", "cast(null as string) lang"))
    assert {r.lang_pred for r in unknown.collect()} == {"und"}


def test_all_segmentations():
    known = {"a": 1, "b": 2, "ab": 3, "ba": 4, "aba": 5}
    chance = np.array([[0.01, 0.2, 0.3, 0.1, 0.25, 0.05], [0.02, 0.3, 0.1, 0.2, 0.15, 0.1]])

    def total(word, row):
        if not word:
            return 1.0
        result = 0.0
        for n in range(1, len(word) + 1):
            piece = known.get(word[:n], 0 if n == 1 else None)
            if piece is not None:
                result += row[piece] * total(word[n:], row)
        return result

    words = ["a", "abab", "abxba", "bbbb"]
    got = language_id.log_chances(words, language_id.Pieces(known), chance)
    for word, logs in zip(words, got):
        assert logs == pytest.approx([np.log(total(word, row)) for row in chance])


def test_long_words_and_pieces(monkeypatch):
    """A word of many characters and a piece of nine, in one batch and in several."""
    known = {"a": 1, "ab": 2, "abababaab": 3, "b": 4}
    row = np.array([0.01, 0.2, 0.3, 0.25, 0.24])
    words = ["ab" * 30, "abababaab" * 7, "xb" * 900, "a"]

    def log_total(word):
        sums = [0.0]
        for end in range(1, len(word) + 1):
            ways = []
            for n in range(1, min(end, 9) + 1):
                piece = known.get(word[end - n : end], 0 if n == 1 else None)
                if piece is not None and (piece or word[end - 1] not in known):
                    ways.append(sums[end - n] + np.log(row[piece]))
            sums.append(np.logaddexp.reduce(ways))
        return sums[-1]

    want = [log_total(w) for w in words]
    for size in (1 << 15, 11):
        monkeypatch.setattr(language_id, "BATCH", size)
        got = language_id.log_chances(words, language_id.Pieces(known), row[None])[:, 0]
        assert got == pytest.approx(want)


def test_word_scores_are_bounded(monkeypatch):
    """Totals do not depend on what is remembered or on how a text is taken apart."""
    pieces = language_id.Pieces({"a": 1, "b": 2, "ab": 3})
    chance = np.array([[0.1, 0.2, 0.3, 0.4], [0.4, 0.3, 0.2, 0.1]])
    texts = ["ab ba", "", "12 3", "abab " * 50 + "b" * 300, "Ab, ba!"]
    want = language_id.WordScores(pieces, chance).totals(texts)
    assert want[1] is want[2] is None and want[0] == pytest.approx(want[4])
    monkeypatch.setattr(language_id, "MANY", 7)
    monkeypatch.setattr(language_id, "KNOWN_BYTES", 0)
    scores = language_id.WordScores(pieces, chance)
    for _ in range(2):
        for got, total in zip(scores.totals(texts), want):
            assert (got is None) == (total is None)
            assert got is None or got == pytest.approx(total)
    assert "b" * 300 not in scores


def test_expected_pieces_add_up():
    """Every segmentation covers the word: expected characters are its length."""
    pieces = language_id.Pieces({"a": 1, "b": 2, "ab": 3})
    chance = np.array([[0.1, 0.3, 0.3, 0.3]])
    total = np.zeros((1, 4))
    language_id._add_expected(
        total, ["abab", "bx"], np.array([0, 0]), np.array([2.0, 3.0]), pieces, chance
    )
    assert total[0] @ np.array([1, 1, 1, 2]) == pytest.approx(4 * 2 + 2 * 3)


def test_known_forgets():
    known = Known(len, most=2)
    assert [known[b"a"], known[b"bb"], known[b"a"], known[b"ccc"]] == [0, 1, 0, 2]
    known.begin_batch()
    assert known.rows == [] and known[b"ccc"] == 0
    measured = Measured(lambda part: (len(part), 0.5), 2, most=2)
    assert [measured[b"a"], measured[b"bb"], measured[b"ccc"]] == [0, 1, 2]
    assert measured.table().tolist() == [[1, 0.5], [2, 0.5], [3, 0.5]]
    measured.begin_batch()
    assert measured[b"ccc"] == 0 and measured.table().tolist() == [[3, 0.5]]


def test_stretches_are_bounded(monkeypatch):
    """What is remembered is measured in bytes; long stretches get numbers but no key."""
    monkeypatch.setattr(toxicity, "KNOWN_BYTES", 2_000)
    known = toxicity.Stretches(toxicity._describer({}))
    codes = [known[s] for s in [b"you", b"x" * 500, b"x" * 500, b"you"]]
    assert codes == [0, 1, 2, 0] and list(known) == [b"you"]
    assert known.table()[codes, 8].tolist() == [3, 500, 500, 3]
    for i in range(20):
        known[b"w%d" % i]
    known.begin_batch()
    assert not known and len(known.table()) == 0


def test_slices_by_bytes(monkeypatch):
    monkeypatch.setattr(toxicity, "SLICE_BYTES", 250)
    texts = pa.array(["a", None, "b" * 900, "", "c"])
    assert list(toxicity._slices(texts)) == [(0, 3), (3, 5)]
    assert list(toxicity._slices(texts.slice(0, 0))) == []


def test_clean_rows_come_back_whole(corpus, docs):
    """Every column of the rows that score lower, as they were."""
    texts, labels = corpus
    model = toxicity.fit(texts, labels)
    scores = {(r.doc_id, r.score < 0.5) for r in model.score(docs).collect()}
    kept = model.keep_clean(docs)
    assert kept.columns == docs.columns
    clean = {k for k, low in scores if low}
    want = sorted(str(r) for r in docs.collect() if r.doc_id in clean)
    assert sorted(map(str, kept.collect())) == want
