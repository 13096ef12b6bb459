"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its state depends on features of the line and of the lines
next to it and on the state before. Labels are of documents; in training every line has
the label of its document. The forward-backward algorithm gives each line's marginal
probability to be good, and a document's quality is their mean, weighted by length.

The weights are fitted on a bounded sample of labelled rows: in each round every
partition of the sample starts from the current weights, takes steps on its own
documents, and the results are averaged by number of documents (parameter mixing).
"""

from __future__ import annotations

import hashlib
import io
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Measured, fold, labelled_sample, parked, utf8
from tripmart.llm.toxicity import LONGEST_KNOWN, Stretches

TRAIN_ROWS = 6_000
TRAIN_LENGTH = 100_000  # characters; longer texts are scored, but not learned from
TRAIN_PARTS = 6
ROUNDS, STEPS = 3, 60
RATE, DECAY = 0.1, 1e-3

WORDLIKE = re.compile(r"\W*[^\W\d_]+(?:['’-][^\W\d_]+)*\W*\Z")
NUMBERS = 8  # of a stretch between white space
SLICE, SLICE_BYTES = 1000, 4 << 20  # texts at once
BLOCK = 128 << 10  # bytes of a longer text at once
STRETCH = re.compile(rb"\S+")
OWN = 11  # features of a line by itself
NEIGHBOUR = 7  # of these, the first ones are also taken from the lines next to it
FEATURES = OWN + 2 * NEIGHBOUR + 3


def describe(part: bytes) -> tuple[float, ...]:
    """Numbers of a stretch between white space."""
    text = part.decode("utf-8", "replace")
    letters = sum(map(str.isalpha, text))
    signs = sum(not c.isalnum() for c in text)
    return (
        float(len(text)),
        float(letters),
        float(letters > 1 and text == text.upper()),
        float(signs),
        float(sum(map(str.isdigit, text))),
        float(WORDLIKE.match(text) is not None),
        float(letters == 0),
        float(signs > 1 or (signs == 1 and text[-1:] not in ".,;:!?")),
    )


class LineStretches(Stretches):
    """Numbers of stretches, bounded in bytes; long ones are known by a digest."""

    def __init__(self) -> None:
        super().__init__(describe, NUMBERS)

    def __missing__(self, part: bytes) -> int:
        if len(part) <= LONGEST_KNOWN:
            return super().__missing__(part)
        # No stretch has a space in it.
        name = b" " + hashlib.blake2b(part, digest_size=16).digest()
        code = self.get(name)
        if code is None:
            self[name] = code = len(self.rows) // self.width
            self.rows.extend(self.describe(part))
            self.held += 200 + 4 * self.width
        return code


def line_features(lines: list[np.ndarray], ends: list[bool], numbers: np.ndarray) -> np.ndarray:
    """A row a line, from the codes of its stretches and whether it ends a sentence."""
    own = np.zeros((len(lines), OWN))
    for i, codes in enumerate(lines):
        n = len(codes)
        if not n:
            own[i, OWN - 1] = 1.0
            continue
        total = sum(
            numbers[codes[at : at + BLOCK]].sum(axis=0, dtype=np.float64)
            for at in range(0, n, BLOCK)
        )
        same = float((codes[1:] == codes[:-1]).sum()) / n
        own[i] = (
            total[2] / n,
            total[3] / total[0],
            total[7] / n,
            same,
            total[6] / n,
            1 - len(np.unique(codes)) / n,
            total[4] / total[0],
            1 - total[5] / n,
            min(n, 50) / 50,
            0.0 if ends[i] else 1.0,
            0.0,
        )
    near = own[:, :NEIGHBOUR]
    none = np.zeros((1, NEIGHBOUR))
    edge = np.zeros((len(lines), 3))
    edge[:, 0], edge[0, 1], edge[-1, 2] = 1.0, 1.0, 1.0
    return np.hstack([own, np.vstack([none, near[:-1]]), np.vstack([near[1:], none]), edge])


def text_lines(text: bytes, known: Measured) -> tuple[list[np.ndarray], list[bool], np.ndarray]:
    """Codes, sentence ends and lengths of a text's lines; an empty text has one line."""
    return coded_lines(text.split(b"\n"), known)


def _codes(line: bytes, known: Measured) -> np.ndarray:
    if len(line) <= BLOCK:
        return np.array([known[s] for s in line.split()], np.int64)
    return np.array(array("q", (known[s[0]] for s in STRETCH.finditer(line))))


def coded_lines(
    lines: list[bytes], known: Measured
) -> tuple[list[np.ndarray], list[bool], np.ndarray]:
    """Codes, sentence ends and lengths of lines."""
    codes = [_codes(line, known) for line in lines]
    ends = [line.rstrip()[-1:] in b".!?:;\"')" and bool(line.strip()) for line in lines]
    return codes, ends, np.array([len(line) + 1.0 for line in lines])


def _read_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The lines of a text that is not empty, about ``BLOCK`` bytes at a time."""
    source = io.BytesIO(text)
    while lines := source.readlines(BLOCK):
        yield [line.removesuffix(b"\n") for line in lines]
    if text.endswith(b"\n"):
        yield [b""]


def _long_emissions(
    text: bytes, weights: np.ndarray, known: Measured
) -> tuple[np.ndarray, np.ndarray]:
    """Scores and lengths of a long text's lines; only these are held for all lines."""
    scores, lengths = [], []
    before, blocks = [], _read_blocks(text)
    lines = next(blocks)
    while lines is not None:
        following = next(blocks, None)
        around = [*before, *lines, *(following or [])[:1]]
        known.begin_batch()
        codes, ends, sizes = coded_lines(around, known)
        own = slice(len(before), len(before) + len(lines))
        scores.append((line_features(codes, ends, known.table()) @ weights)[own])
        lengths.append(sizes[own])
        before, lines = lines[-1:], following
    return np.concatenate(scores), np.concatenate(lengths)


def emissions(
    texts: list[bytes], weights: np.ndarray, known: Measured
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its lines' scores, good against bad, and their lengths."""
    known.begin_batch()
    short = {i: text_lines(t, known) for i, t in enumerate(texts) if len(t) <= BLOCK}
    numbers = known.table()
    found = {i: (line_features(c, e, numbers) @ weights, n) for i, (c, e, n) in short.items()}
    for i, text in enumerate(texts):
        if i not in found:
            found[i] = _long_emissions(text, weights, known)
    return [found[i] for i in range(len(texts))]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Begin and end of runs of texts, bounded in number and closed by the text that fills them."""
    begin, size = 0, 0
    for at, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist(), 1):
        size += n
        if size >= SLICE_BYTES or at - begin == SLICE or at == len(texts):
            yield begin, at
            begin, size = at, 0


def _log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(
    emit: np.ndarray, step: np.ndarray, count: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward for many chains of two states at once.

    ``emit`` (chains x lines) scores the state good against bad, ``step`` the moves from
    and to a state, ``count`` the lines of each chain. Gives log Z, the marginal of good
    (chains x lines) and the expected number of each move.
    """
    chains, most = emit.shape
    ahead = np.zeros((chains, most, 2))
    ahead[:, 0, 1] = emit[:, 0]
    for t in range(1, most):
        for to in (0, 1):
            come = _log_sum(ahead[:, t - 1, 0] + step[0, to], ahead[:, t - 1, 1] + step[1, to])
            ahead[:, t, to] = come + (emit[:, t] if to else 0.0)
    back = np.zeros((chains, most, 2))
    for t in range(most - 2, -1, -1):
        inside = (t + 1 < count)[:, None]
        go = np.stack(
            [
                _log_sum(
                    step[at, 0] + back[:, t + 1, 0],
                    step[at, 1] + emit[:, t + 1] + back[:, t + 1, 1],
                )
                for at in (0, 1)
            ],
            axis=1,
        )
        back[:, t] = np.where(inside, go, 0.0)
    last = ahead[np.arange(chains), count - 1]
    log_z = _log_sum(last[:, 0], last[:, 1])
    inside = np.arange(most)[None, :] < count[:, None]
    good = np.where(inside, np.exp(ahead[:, :, 1] + back[:, :, 1] - log_z[:, None]), 0.0)
    moves = np.zeros((2, 2))
    if most > 1:
        for at in (0, 1):
            for to in (0, 1):
                score = ahead[:, :-1, at] + step[at, to] + back[:, 1:, to] - log_z[:, None]
                score = score + (emit[:, 1:] if to else 0.0)
                moves[at, to] = np.exp(np.where(inside[:, 1:], score, -np.inf)).sum()
    return log_z, good, moves


def _odds(odds, step: np.ndarray):
    """Log odds of the next state from those of this one, seen along or against a chain."""
    return np.logaddexp(step[0, 1], odds + step[1, 1]) - np.logaddexp(
        step[0, 0], odds + step[1, 0]
    )


def line_marginals(emit: np.ndarray, step: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The marginals of good that ``marginals`` gives, by log odds, one number a line."""
    chains, most = emit.shape
    if chains == 1:
        return _one_chain(emit[0], step)[None, :]
    good, behind = np.array(emit), np.zeros(chains)
    for t in range(1, most):
        good[:, t] += _odds(good[:, t - 1], step)
    for t in range(most - 2, -1, -1):
        behind = np.where(t + 1 < count, _odds(behind + emit[:, t + 1], step.T), 0.0)
        good[:, t] += behind
    return 1 / (1 + np.exp(-np.clip(good, -700, 700)))


def _one_chain(emit: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The same for one chain, however long, with plain numbers."""
    (s00, s01), (s10, s11) = step.tolist()

    def log_sum(a: float, b: float) -> float:
        return max(a, b) + math.log1p(math.exp(-abs(a - b)))

    good, odds = array("d"), None
    for e in map(float, emit):
        odds = e if odds is None else e + log_sum(s01, odds + s11) - log_sum(s00, odds + s10)
        good.append(odds)
    behind = 0.0
    for t in range(len(good) - 2, -1, -1):
        go = behind + float(emit[t + 1])
        behind = log_sum(s10, go + s11) - log_sum(s00, go + s01)
        good[t] += behind
    return 1 / (1 + np.exp(-np.clip(np.array(good), -700, 700)))


def _grouped(counts: np.ndarray, cells: int = 200_000) -> Iterator[np.ndarray]:
    """Chains of similar length together, each group a bounded number of cells."""
    order = np.argsort(counts, kind="stable")[::-1]
    at = 0
    while at < len(order):
        size = max(1, cells // int(counts[order[at]]))
        yield order[at : at + size]
        at += size


def _padded(emit: np.ndarray, starts: np.ndarray, counts: np.ndarray, group: np.ndarray):
    most = int(counts[group].max())
    where = starts[group][:, None] + np.arange(most)[None, :]
    inside = np.arange(most)[None, :] < counts[group][:, None]
    return np.where(inside, emit[np.minimum(where, len(emit) - 1)], 0.0), where, inside


def _gradient(weights, step, features, labels, starts, counts):
    """Of the mean log likelihood; every line of a document has the document's label."""
    emit, slope, step_slope = features @ weights, np.zeros_like(weights), np.zeros((2, 2))
    line_label = np.repeat(labels, counts).astype(float)
    miss = np.zeros(len(features))
    for group in _grouped(counts):
        padded, where, inside = _padded(emit, starts, counts, group)
        _, good, moves = marginals(padded, step, counts[group])
        miss[where[inside]] = good[inside]
        step_slope -= moves
        for label in (0, 1):
            step_slope[label, label] += (counts[group][labels[group] == label] - 1).sum()
    slope = features.T @ (line_label - miss)
    return slope / len(counts), step_slope / len(counts)


def fit_locally(weights, step, features, labels, counts, steps: int = STEPS):
    """Adam steps on the documents of one partition."""
    starts = np.cumsum(counts) - counts
    both = np.concatenate([weights, step.ravel()])
    m, v = np.zeros_like(both), np.zeros_like(both)
    for t in range(1, steps + 1):
        slope, step_slope = _gradient(
            both[:-4], both[-4:].reshape(2, 2), features, labels, starts, counts
        )
        g = np.concatenate([slope, step_slope.ravel()]) - DECAY * both
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        both = both + RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        both[-4:] = np.clip(both[-4:], -4, 4)
    return both[:-4], both[-4:].reshape(2, 2)


def train(labelled: DataFrame, folds: int = 4, held_out: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Weights of features and moves from rows (doc_id, text, label) outside a fold.

    At most ``TRAIN_ROWS`` rows in the order of a hash, with texts of up to
    ``TRAIN_LENGTH`` characters; null labels are skipped. Without
    rows all weights are zero, and every text scores one half.
    """
    rows = (
        labelled.where(F.col("label").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
        .where(F.coalesce(F.length("text"), F.lit(0)) <= TRAIN_LENGTH)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_ROWS)
    )
    sample = parked(
        rows.select(F.col("label").cast("int").alias("label"), "text").repartition(TRAIN_PARTS),
        "labelled",
    )
    weights, step = np.zeros(FEATURES), np.zeros((2, 2))
    for _ in range(ROUNDS):
        begin = (weights.copy(), step.copy())

        def local(batches: Iterator[pa.RecordBatch], begin=begin) -> Iterator[pa.RecordBatch]:
            known, parts, labels, counts = LineStretches(), [], [], []
            for whole in batches:
                for begin_at, end_at in _slices(whole.column(1)):
                    batch = whole.slice(begin_at, end_at - begin_at)
                    known.begin_batch()
                    found = [text_lines(utf8(text), known) for text in batch.column(1)]
                    numbers = known.table()
                    for label, (lines, ends, _) in zip(batch.column(0).to_pylist(), found):
                        parts.append(line_features(lines, ends, numbers))
                        labels.append(label)
                        counts.append(len(lines))
            if parts:
                new, moves = fit_locally(
                    *begin, np.vstack(parts), np.array(labels), np.array(counts)
                )
                values = [*new.tolist(), *moves.ravel().tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([values], pa.list_(pa.float64())), pa.array([len(labels)])],
                    ["weights", "n"],
                )

        fitted = sample.mapInArrow(local, "weights array<double>, n bigint").collect()
        if fitted:
            n = np.array([r["n"] for r in fitted], float)
            mean = (np.array([r["weights"] for r in fitted]) * n[:, None]).sum(axis=0) / n.sum()
            weights, step = mean[:-4], mean[-4:].reshape(2, 2)
    return weights, step


def score_texts(
    docs: DataFrame,
    weights: np.ndarray,
    step: np.ndarray,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Id, ``score`` and ``lines``, the marginal of every line, for every row.

    Texts are taken a few megabytes at a time, a very long one in blocks of lines, of
    which a number a line stays: its score, then its marginal.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LineStretches()
        for batch in batches:
            for begin, end in _slices(batch.column(1)):
                part = batch.slice(begin, end - begin)
                found = emissions([utf8(text) for text in part.column(1)], weights, known)
                counts = np.array([len(n) for _, n in found])
                emit = np.concatenate([e for e, _ in found])
                starts = np.cumsum(counts) - counts
                good = np.zeros(len(emit))
                for group in _grouped(counts):
                    padded, where, inside = _padded(emit, starts, counts, group)
                    good[where[inside]] = line_marginals(padded, step, counts[group])[inside]
                lengths = np.concatenate([n for _, n in found])
                total = np.add.reduceat(good * lengths, starts) / np.add.reduceat(lengths, starts)
                lines = np.split(np.clip(good, 0, 1), starts[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.clip(total, 0, 1)),
                        pa.array(lines, pa.list_(pa.float64())),
                    ],
                    ["_id", "score", "lines"],
                )

    return rows.mapInArrow(
        score, f"_id {id_type}, score double, lines array<double>"
    ).withColumnRenamed("_id", id_col)


def quality(docs: DataFrame, labels: DataFrame, least: float = 0.7) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    Trained on the documents that ``labels`` (doc_id, quality) covers outside the held-out
    fold; labels, language, source and id are no input of a score. A null text is an empty
    one, which is a single empty line. Repeated rows get the same score; an empty table
    gives an empty result.
    """
    weights, step = train(labelled_sample(docs, labels, "quality", 4, 2, TRAIN_ROWS))
    held_out = fold(F.col("doc_id"), 4) == 2
    return score_texts(docs, weights, step).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )
