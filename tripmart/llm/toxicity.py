"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a lexicon (words and beginnings of words with their
log odds), how near its words stand to a second person, capitals, punctuation, and
disguised spellings. The lexicon is learned from labelled texts: from each half of the
training rows for the rows of the other half, so that the trees see how well it carries
over, and from both for all other texts. Trees and the calibration use different rows.

All fitting is on a bounded sample of labelled rows, ``TRAIN_ROWS`` in the order of a
hash; scoring is one pass over the texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import Measured, fold, labelled_sample, parked, utf8

TRAIN_ROWS = 20_000
LEXICON = 4_000
PREFIXES = (4, 5, 6)
STRONG = 3.0  # log odds from which a word counts as a hit
TREES, DEPTH = 20, 3
NEAR = 6  # words
# Second persons, and common insults that need no learning.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch sie ihnen tu toi te ton "
    "ta tes vous votre vos tú ti tuyo usted ustedes vosotros vos os su".split()
)
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers scum trash worthless pathetic clown "
    "disgusting imbecile jerk filth vermin bastard dumbass".split()
)
LETTERS = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"[^\W\d_][0-9@$!*#%]+[^\W\d_]|([^\W\d_])\1{3,}")
FEATURES, NUMBERS = 12, 9  # of a text, of a stretch between white space
SLICE_BYTES = 2 << 20  # texts at once
KNOWN_BYTES = 32 << 20  # of the stretches that a task remembers
LONGEST_KNOWN = 128  # bytes of a stretch that is remembered


def _keys(word: str) -> list[str]:
    """A word and its beginnings, marked as such."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


def _words_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of each labelled text with its half and label, one row a key and batch."""
    for batch in batches:
        counts: dict[tuple[str, int, int], int] = {}
        for half, label, text in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
        ):
            words = set(LETTERS.findall((text.as_py() or "").lower()))
            for key in {k for w in words for k in _keys(w)}:
                place = (key, half, label)
                counts[place] = counts.get(place, 0) + 1
        places = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in places], pa.string()),
                pa.array([p[1] for p in places], pa.int32()),
                pa.array([p[2] for p in places], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            ["key", "half", "label", "n"],
        )


def learn_lexicons(rows: DataFrame) -> list[dict[str, float]]:
    """From rows (half 1 or 2, label, text): lexicons of both halves, of half 1, of half 2.

    An entry is in at least three toxic texts; the best ``LEXICON`` of all are kept.
    """
    totals = {(r[0], r[1]): r[2] for r in rows.groupBy("half", "label").count().collect()}

    def total(label: int, halves) -> int:
        return sum(totals.get((h, label), 0) for h in halves)

    def some(label: int, half: int):
        mine = (F.col("label") == label) & (F.col("half") == half)
        return F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)).alias(f"n{label}{half}")

    def odds(toxic, clean, halves, log):
        up = log((toxic + 0.5) / (total(1, halves) + 1.0))
        return up - log((clean + 0.5) / (total(0, halves) + 1.0))

    counts = (
        rows.select("half", "label", "text")
        .mapInArrow(_words_of_rows, "key string, half int, label int, n bigint")
        .groupBy("key")
        .agg(*[some(label, half) for label in (0, 1) for half in (1, 2)])
        .where("n11 + n12 >= 3")
    )
    rank = odds(F.col("n11") + F.col("n12"), F.col("n01") + F.col("n02"), (1, 2), F.log)
    entries = counts.withColumn("odds", rank).where("odds > 1")
    best = entries.orderBy(F.col("odds").desc(), "key").limit(LEXICON).collect()
    lexicons: list[dict[str, float]] = [{}, {}, {}]
    for r in best:
        lexicons[0][r["key"]] = r["odds"]
        for half in (1, 2):
            if r[f"n1{half}"]:
                value = odds(r[f"n1{half}"], r[f"n0{half}"], (half,), math.log)
                lexicons[half][r["key"]] = value
    return lexicons


def _describer(lexicon: dict[str, float]):
    def describe(part: bytes) -> tuple[float, ...]:
        """Numbers of a stretch between white space."""
        text = part.decode("utf-8", "replace")
        low = text.lower()
        words = LETTERS.findall(low)
        best = max((lexicon.get(k, 0.0) for w in words for k in _keys(w)), default=0.0)
        letters = sum(map(len, words))
        return (
            max(best, 0.0),
            float(best >= STRONG),
            float(any(w in INSULTS for w in words)),
            float(any(w in SECOND_PERSON for w in words)),
            float(letters > 1 and text != low and text == text.upper()),
            float(len(text) - letters),
            float(text.count("!") + text.count("?")),
            float(DISGUISED.search(low) is not None),
            float(len(text)),
        )

    return describe


def _features(numbers: np.ndarray) -> list[float]:
    """A text's features from the numbers of its stretches."""
    n = len(numbers)
    if not n:
        return [0.0] * FEATURES
    total = numbers.sum(axis=0, dtype=np.float64)
    hits = np.flatnonzero((numbers[:, 1] > 0) | (numbers[:, 2] > 0))
    persons = np.flatnonzero(numbers[:, 3])
    near = 0
    if len(hits) and len(persons):
        at = np.searchsorted(persons, hits)
        left = hits - persons[np.maximum(at - 1, 0)]
        right = persons[np.minimum(at, len(persons) - 1)] - hits
        near = int((np.minimum(np.abs(left), np.abs(right)) <= NEAR).sum())
    return [
        float(total[0] / n),
        float(numbers[:, 0].max()),
        math.log1p(total[1]),
        total[1] / n,
        math.log1p(total[2]),
        near / n,
        total[3] / n,
        total[4] / n,
        total[5] / total[8],
        total[6] / n,
        total[7] / n,
        math.log1p(n),
    ]


class Stretches(Measured):
    """Numbers of the stretches met, bounded in bytes.

    Long stretches, such as texts without white space, are measured each time and never
    kept as a key; all is forgotten between slices once it is more than ``KNOWN_BYTES``.
    """

    def __init__(self, describe, width: int = NUMBERS) -> None:
        super().__init__(describe, width)
        self.held = 0

    def __missing__(self, part: bytes) -> int:
        code = len(self.rows) // self.width
        self.rows.extend(self.describe(part))
        self.held += 4 * self.width
        if len(part) <= LONGEST_KNOWN:
            self[part] = code
            self.held += len(part) + 150  # with what Python and the table of keys take
        return code

    def begin_batch(self) -> None:
        if self.held > KNOWN_BYTES:
            self.clear()
            del self.rows[:]
            self.held = 0


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Begin and end of runs of texts, each closed by the text that fills it."""
    begin, size = 0, 0
    for at, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist(), 1):
        size += n + 100
        if size >= SLICE_BYTES or at == len(texts):
            yield begin, at
            begin, size = at, 0


def text_features(
    rows: DataFrame, lexicons: list[dict[str, float]], inside: int | None = None
) -> DataFrame:
    """``rows`` (_id, other, half, text) with features for the text.

    ``half`` names the lexicon: 0 the whole one, else the one of the other half. With
    ``inside`` the text is that field of ``_id`` and no column of its own.
    """
    schema = (
        T.StructType()
        .add("_id", rows.schema["_id"].dataType)
        .add("other", T.IntegerType())
        .add("features", T.ArrayType(T.DoubleType()))
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {h: Stretches(_describer(lexicons[(0, 2, 1)[h]])) for h in (0, 1, 2)}
        for batch in batches:
            keys = batch.column(0)
            texts = batch.column(3) if inside is None else pc.struct_field(keys, [inside])
            for begin, end in _slices(texts):
                for k in known.values():
                    k.begin_batch()
                halves = batch.column(2).slice(begin, end - begin).to_pylist()
                codes = []
                for half, text in zip(halves, texts.slice(begin, end - begin)):
                    mine = known[half]
                    codes.append(np.array([mine[s] for s in utf8(text).split()], np.int32))
                tables = {h: known[h].table() for h in set(halves)}
                found = [_features(tables[h][c]) for h, c in zip(halves, codes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(begin, end - begin),
                        batch.column(1).slice(begin, end - begin),
                        pa.array(found, pa.list_(pa.float64())),
                    ],
                    ["_id", "other", "features"],
                )

    columns = ["_id", "other", "half", *(["text"] if inside is None else [])]
    return rows.select(*columns).mapInArrow(compute, schema)


class ToxicityModel:
    """Lexicon, trees and calibration; constant where the labels have one class only."""

    def __init__(self, lexicons, trees, isotonic, prior: float) -> None:
        self.lexicons, self.trees, self.isotonic, self.prior = lexicons, trees, isotonic, prior

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Id and ``score`` of every row, 0 to 1. A null text is an empty one."""
        return self._scored(docs, F.col(id_col), text_col).withColumnRenamed("_id", id_col)

    def keep_clean(self, docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
        """The rows of ``docs`` scored below ``least``, passed through without a shuffle.

        A row travels once, with its text inside. A null text is an empty one; repeated
        rows stay or go together, an empty table gives an empty one with its columns.
        """
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        scored = self._scored(docs, row, text_col, docs.columns.index(text_col))
        return scored.where(F.col("score") < least).select("_id.*")

    def _scored(
        self, docs: DataFrame, key: Column, text_col: str, inside: int | None = None
    ) -> DataFrame:
        zero = F.lit(0)
        rows = docs.select(key.alias("_id"), zero.alias("other"), zero.alias("half"),
                           *([F.col(text_col).alias("text")] if inside is None else []))
        if self.trees is None:
            return rows.select("_id", F.lit(self.prior).alias("score"))
        scored = _raw(self.trees, text_features(rows, self.lexicons, inside))
        if self.isotonic:
            scored = self.isotonic.transform(scored)
        else:
            scored = scored.withColumn("prediction", F.col("raw"))
        # The steps of the calibration keep the order of the trees within them.
        score = F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0))
        return scored.select("_id", (score * 0.999 + F.col("raw") * 0.001).alias("score"))


def _raw(trees, features: DataFrame) -> DataFrame:
    """The trees' probability as ``raw``."""
    scored = trees.transform(features.withColumn("vector", array_to_vector("features")))
    return scored.withColumn("raw", vector_to_array("probability")[1]).drop(
        "vector", "rawPrediction", "probability", "prediction"
    )


def train(labelled: DataFrame, folds: int = 5, held_out: int = 0) -> ToxicityModel:
    """Fit on rows (doc_id, text, label) outside the held-out fold.

    Null labels are skipped; at most ``TRAIN_ROWS`` rows are used.
    """
    number = fold(F.col("doc_id"), folds)
    rows = (
        labelled.where(F.col("label").isNotNull() & (number != held_out))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_ROWS)
        .select(
            F.col("doc_id").alias("_id"),
            F.col("label").cast("int").alias("label"),
            (F.crc32(F.concat(F.lit("half"), F.col("doc_id").cast("string"))) % 2 + 1)
            .cast("int")
            .alias("half"),
            (F.crc32(F.concat(F.lit("use"), F.col("doc_id").cast("string"))) % 4)
            .cast("int")
            .alias("use"),
            "text",
        )
    )
    rows = parked(rows.repartition(8, "_id"), "labelled")
    seen = {(r[0], r[1] == 3): r[2] for r in rows.groupBy("label", "use").count().collect()}
    toxic = sum(n for (label, _), n in seen.items() if label == 1)
    clean = sum(n for (label, _), n in seen.items() if label == 0)
    prior = (toxic + 0.5) / (toxic + clean + 1.0)
    if not toxic or not clean:
        return ToxicityModel(None, None, None, prior)
    lexicons = learn_lexicons(rows)
    # What the trees do not need travels in one number: label and use.
    packed = rows.withColumn("other", F.col("label") * 4 + F.col("use"))
    described = parked(text_features(packed, lexicons), "features").select(
        F.floor(F.col("other") / 4).cast("double").alias("label"),
        (F.col("other") % 4).alias("use"),
        array_to_vector("features").alias("vector"),
        "features",
    )
    trees = GBTClassifier(
        featuresCol="vector",
        labelCol="label",
        maxIter=TREES,
        maxDepth=DEPTH,
        stepSize=0.3,
        minInstancesPerNode=3,
        seed=7,
    ).fit(described.where("use <> 3"))
    known = _raw(trees, described.where("use = 3").select("label", "features"))
    isotonic = None
    if known.select("label").distinct().count() == 2:
        isotonic = IsotonicRegression(featuresCol="raw", labelCol="label").fit(known)
    return ToxicityModel(lexicons, trees, isotonic, prior)


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on the rows of ``docs`` that ``labels`` (doc_id, toxic) covers."""
    return train(labelled_sample(docs, labels, "toxic", 5, 0, TRAIN_ROWS))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    Trained on the documents that ``labels`` (doc_id, toxic) covers outside the held-out
    fold. Labels, language, source and id are no input of a score. Repeated rows get the
    same score, null texts that of an empty text; an empty table gives an empty result.
    """
    model = fit(docs, labels)
    held_out = fold(F.col("doc_id"), 5) == 0
    return model.score(docs).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
