"""Line marginals by log odds, and long texts in blocks, against the plain way."""

import random
import resource

import numpy as np
import pytest

from tripmart.llm import quality_crf as q


@pytest.mark.parametrize("chains", [1, 4])
def test_log_odds_equal_forward_backward(chains):
    rng = np.random.default_rng(chains)
    emit, step = 3 * rng.standard_normal((chains, 40)), 2 * rng.standard_normal((2, 2))
    count = np.array([40, 17, 1, 40][:chains])
    inside = np.arange(40)[None, :] < count[:, None]
    want = q.marginals(emit, step, count)[1]
    assert np.allclose(q.line_marginals(emit, step, count)[inside], want[inside], atol=1e-12)


def test_far_odds_do_not_overflow():
    emit, step = np.array([[5000.0, -5000.0, 0.0]] * 2), np.array([[4.0, -4.0], [-4.0, 4.0]])
    for rows in (emit, emit[:1]):
        got = q.line_marginals(rows, step, np.array([3] * len(rows)))
        assert np.isfinite(got).all() and got[0, 0] == 1 and got[0, 1] < 1e-200


def plain(texts, weights):
    known, found = q.Measured(q.describe, q.NUMBERS), []
    for text in texts:
        codes, ends, sizes = q.text_lines(text, known)
        found.append((q.line_features(codes, ends, known.table()) @ weights, sizes))
    return found


def test_blocks_equal_whole_texts(monkeypatch):
    rng = random.Random(5)
    words = [b"word", b"A,B", b"77", b"\xc3\xa9t\xc3\xa9.", b"x" * 300, b"y" * 300, b"a\x0bb"]
    texts = [
        b"\n".join(
            b" ".join(rng.choices(words, k=rng.randrange(6))) for _ in range(rng.randrange(60))
        )
        for _ in range(60)
    ]
    texts += [b"", b"\n", b"\n\n\n", b"one", b"end\n", b"x" * 5000, b"w v " * 2000]
    weights = np.random.default_rng(1).standard_normal(q.FEATURES)
    want = plain(texts, weights)
    for block in (1, 7, 64, 1000, 1 << 20):
        monkeypatch.setattr(q, "BLOCK", block)
        for (a, n), (b, m) in zip(q.emissions(texts, weights, q.LineStretches()), want):
            assert np.allclose(a, b) and (n == m).all()


def test_a_million_lines_in_bounded_memory():
    weights = np.random.default_rng(2).standard_normal(q.FEATURES)
    step = np.array([[1.0, -1.0], [-1.0, 1.0]])
    text = b"Some words stand here.\n" * 1_000_000
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    ((emit, lengths),) = q.emissions([text], weights, q.LineStretches())
    good = q.line_marginals(emit[None, :], step, np.array([len(emit)]))
    assert len(lengths) == good.shape[1] == 1_000_001
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300 << 10  # KB
