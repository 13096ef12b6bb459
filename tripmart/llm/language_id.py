"""Language by unigram pieces, summed over all segmentations.

The pieces of a fixed public vocabulary have a probability in each language. A word's
probability is the sum over all ways to cut it into pieces, which a forward pass over its
characters gives; a text is the product of its words. Probabilities are learned by
expectation maximisation: the same pass with its mirror image says how often each piece
is expected in the training words of a language. Sums are of logarithms, so words of any
length keep their value.

Training is on a bounded sample of labelled rows, about ``TRAIN_ROWS`` a language below a
threshold on a hash, as a table of distinct words. Each round is one Spark job that adds
expected counts by language and piece, a table no larger than the vocabulary for each
language.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import fold, parked, utf8

TRAIN_ROWS = 400
TRAIN_LENGTH = 100_000  # characters of the longest training text
ROUNDS = 3
SMOOTHING = 0.1
BATCH = 1 << 15  # characters of words scored at once
SLICE_BYTES = 4 << 20  # of texts at once
KNOWN_BYTES = 64 << 20  # remembered words of a task
LONGEST_KNOWN = 64  # characters of a word that is remembered
MANY = 100_000  # words of a text added up at once
UNKNOWN = 0  # a single character that the vocabulary lacks
LETTERS = re.compile(r"[^\W\d_]+")
BEGIN = "▁"  # marks the beginning of a word in the vocabulary


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Numbered pieces, found wherever they lie in a word by one automaton."""

    def __init__(self, known: dict[str, int]) -> None:
        self.size = len(known) + 1
        self.length = np.ones(self.size, np.int64)
        self.finder = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece, number in known.items():
            self.finder.add_word(piece, number)
            self.length[number] = len(piece)
        self.longest = int(self.length.max())
        if known:
            self.finder.make_automaton()

    def within(self, words: list[str], begin: int, end: int):
        """Pieces that end at the characters ``begin`` to ``end`` of each word.

        Arrays of word, position after the piece, its length and number. A character that
        is no piece is ``UNKNOWN``, so every position has a piece.
        """
        first = max(begin - self.longest + 1, 0)
        parts = [w[first:end] for w in words]
        blob = "\n".join(parts)
        start = np.concatenate([[0], np.cumsum([len(x) + 1 for x in parts])])
        found = itertools.chain.from_iterable(self.finder.iter(blob) if self.size > 1 else ())
        at, number = np.fromiter(found, np.int64).reshape(-1, 2).T
        lone = np.ones(len(blob), bool)
        lone[at[self.length[number] == 1]] = False
        lone[start[1:-1] - 1] = False  # between words
        lone = np.flatnonzero(lone)
        at = np.concatenate([at, lone])
        number = np.concatenate([number, np.full(len(lone), UNKNOWN)])
        word = np.searchsorted(start, at, "right") - 1
        position = at - start[word] + first + 1
        new = position > begin
        return word[new], position[new], self.length[number[new]], number[new]


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The vocabulary's pieces of letters in lower case, numbered from 1."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known: dict[str, int] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).lower()
        if LETTERS.fullmatch(piece.replace(BEGIN, "a")):
            known.setdefault(piece, len(known) + 1)
    return Pieces(known)


def _runs(key: np.ndarray) -> Iterator[np.ndarray]:
    """Places of equal keys, in ascending order of the key."""
    order = np.argsort(key, kind="stable")
    ends = np.flatnonzero(np.diff(key[order])) + 1
    yield from np.split(order, ends) if len(order) else ()


def _batches(words: list[str]) -> Iterator[np.ndarray]:
    """Places of words of like length, longest first, up to ``BATCH`` characters or one word."""
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    some, size = [], 0
    for i in order:
        if some and size + len(words[i]) > BATCH:
            yield np.array(some)
            some, size = [], 0
        some.append(i)
        size += len(words[i])
    if some:
        yield np.array(some)


def log_chances(words: list[str], known: Pieces, chance: np.ndarray) -> np.ndarray:
    """Log probability (words x languages) of each word in each language.

    The forward pass keeps sums for as many positions as the longest piece has characters.
    """
    result = np.zeros((len(words), len(chance)))
    logs = np.log(chance).T.copy()
    ring = known.longest + 1
    for some in _batches(words):
        part = [words[i] for i in some]
        length = np.array([len(w) for w in part])
        sums = np.full((ring, len(part), len(chance)), -np.inf)
        sums[0] = 0.0
        last = 0
        for begin in range(0, int(length[0]), BATCH):
            word, end, n, number = known.within(part, begin, begin + BATCH)
            for run in _runs(end * ring + n):
                at, back, who = int(end[run[0]]), int(n[run[0]]), word[run]
                if at != last:
                    sums[at % ring] = -np.inf
                    last = at
                ways = sums[(at - back) % ring, who] + logs[number[run]]
                if back > 1:  # the shortest piece comes first
                    ways = np.logaddexp(sums[at % ring, who], ways)
                sums[at % ring, who] = ways
                # Longer pieces overwrite what a word's last position holds so far.
                done = who[length[who] == at]
                result[some[done]] = sums[at % ring, done]
    return result


class LanguageModel:
    """Languages in order and their piece probabilities (languages x pieces)."""

    def __init__(self, languages: list[str], chance: np.ndarray, path: str) -> None:
        self.languages, self.chance, self.path = languages, chance, path

    def predict(
        self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
    ) -> DataFrame:
        """Id, ``lang_pred`` and ``score``, its posterior probability, for every row.

        A text that is null or has no letter is ``und`` with the score 0, as is every
        text if no language was learned. Texts and words of any length are scored whole, in
        memory bounded by the bytes of one text.
        """
        rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        id_type = rows.schema["_id"].dataType.simpleString()
        languages, chance, path = self.languages, self.chance, self.path

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = WordScores(pieces(path), chance)
            for batch in batches:
                names, chances = [], []
                for begin, end in _slices(batch.column(1)):
                    texts = batch.column(1).slice(begin, end - begin)
                    for total in known.totals(utf8(t).decode("utf-8", "replace") for t in texts):
                        if total is None or not languages:
                            names.append("und")
                            chances.append(0.0)
                            continue
                        best = int(total.argmax())
                        names.append(languages[best])
                        chances.append(float(1 / np.exp(total - total[best]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(names, pa.string()), pa.array(chances, pa.float64())],
                    ["_id", "lang_pred", "score"],
                )

        return rows.mapInArrow(
            predict, f"_id {id_type}, lang_pred string, score double"
        ).withColumnRenamed("_id", id_col)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Begin and end of runs of texts, each closed by the text that fills it."""
    begin, size = 0, 0
    for at, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist(), 1):
        size += n + 100
        if size >= SLICE_BYTES or at == len(texts):
            yield begin, at
            begin, size = at, 0


class WordScores(dict):
    """Places of words in a table of log probabilities, remembered from text to text.

    Between slices all is forgotten once it takes more than ``KNOWN_BYTES``; words of more
    than ``LONGEST_KNOWN`` characters are scored each time and never kept.
    """

    def __init__(self, known: Pieces, chance: np.ndarray) -> None:
        super().__init__()
        self.known, self.chance = known, chance
        self.fresh: list[str] = []
        self.scores = np.zeros((0, len(chance)))

    def __missing__(self, word: str) -> int:
        place = len(self.scores) + len(self.fresh)
        self.fresh.append(BEGIN + word)
        if len(word) <= LONGEST_KNOWN:
            self[word] = place
        return place

    def _settle(self) -> None:
        """Score the words met since."""
        if self.fresh:
            new = log_chances(self.fresh, self.known, self.chance)
            self.scores = np.vstack([self.scores, new])
            self.fresh = []

    def totals(self, texts: Iterator[str]) -> list[np.ndarray | None]:
        """Sums over the words of each text, None for a text without letters."""
        # A number for each language, and what Python takes for a short word.
        if len(self.scores) * (8 * len(self.chance) + 250) > KNOWN_BYTES:
            self.clear()
            self.scores = self.scores[:0]
        codes: list[list[np.ndarray]] = []
        sums: list[np.ndarray | None] = []
        for text in texts:
            mine, total = [], None
            low = text.lower()
            if len(low) <= MANY:
                parts = [LETTERS.findall(low)]
            else:
                parts = itertools.batched((m.group() for m in LETTERS.finditer(low)), MANY)
            for words in parts:
                if len(mine) == 1:  # a text of very many words: not all their places are kept
                    self._settle()
                    total = self._add(total, mine.pop())
                mine.append(np.fromiter((self[w] for w in words), np.int64, len(words)))
            codes.append(mine)
            sums.append(total)
        self._settle()
        for i, mine in enumerate(codes):
            for places in mine:
                sums[i] = self._add(sums[i], places)
        return sums

    def _add(self, total: np.ndarray | None, places: np.ndarray) -> np.ndarray | None:
        if not len(places):
            return total
        part = self.scores[places].sum(axis=0)
        return part if total is None else total + part


def _training_words(sample: DataFrame) -> DataFrame:
    """Distinct words by language with their number, ``lang``, ``word``, ``n``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[int, str], int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word in LETTERS.findall((text.as_py() or "").lower()):
                    key = lang, BEGIN + word
                    counts[key] = counts.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in counts], pa.int32()),
                    pa.array([k[1] for k in counts], pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["lang", "word", "n"],
            )

    rows = sample.mapInArrow(count, "lang int, word string, n bigint")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(
    labelled: DataFrame, folds: int = 4, held_out: int = 2, vocabulary: str | None = None
) -> LanguageModel:
    """Fit on rows (doc_id, text, lang) outside the held-out fold; null languages are skipped.

    A language's sample is what lies below a threshold on a hash of id and text, at which
    ``TRAIN_ROWS`` of its distinct rows are expected; texts of more than ``TRAIN_LENGTH``
    characters are not learned from unless all of a language's are longer.
    """
    path = vocabulary or default_vocabulary()
    size = pieces(path).size
    usable = labelled.where(
        F.col("lang").isNotNull()
        & F.col("text").isNotNull()
        & (fold(F.col("doc_id"), folds) != held_out)
    )
    choice = F.xxhash64("doc_id", "text")
    short = F.length("text") <= TRAIN_LENGTH
    # A row for each language.
    found = sorted(
        usable.groupBy("lang")
        .agg(F.approx_count_distinct(F.when(short, choice)), F.approx_count_distinct(choice))
        .collect()
    )
    languages = [r[0] for r in found]
    if not languages:
        return LanguageModel([], np.zeros((0, size)), path)
    names = F.array(*[F.lit(x) for x in languages])
    bounds = F.array(*[F.lit(int(min(1.0, TRAIN_ROWS / (r[1] or r[2] or 1)) * (1 << 40))) for r in found])
    lengths = F.array(*[F.lit(TRAIN_LENGTH if r[1] else 2**31 - 1) for r in found])
    number = F.array_position(names, F.col("lang")).cast("int")
    sample = (
        usable.withColumn("number", number)
        .where(F.pmod(choice, F.lit(1 << 40)) < F.element_at(bounds, F.col("number")))
        .where(F.length("text") <= F.element_at(lengths, F.col("number")))
        .groupBy("number", choice.alias("choice"))
        .agg(F.first("text").alias("text"))
        .select((F.col("number") - 1).alias("number"), "text")
    )
    words = parked(_training_words(sample), "words")
    words = words.repartition(8, "word")
    chance = np.full((len(languages), size), 1.0 / size)
    for _ in range(ROUNDS):

        def expect(
            batches: Iterator[pa.RecordBatch], chance=chance
        ) -> Iterator[pa.RecordBatch]:
            known, total = pieces(path), np.zeros((len(languages), size))
            for batch in batches:
                _add_expected(
                    total,
                    batch.column(1).to_pylist(),
                    batch.column(0).to_numpy(),
                    batch.column(2).to_numpy(),
                    known,
                    chance,
                )
            lang, piece = np.nonzero(total > 1e-6)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lang.astype(np.int32)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(total[lang, piece]),
                ],
                ["lang", "piece", "n"],
            )

        counts = (
            words.select("lang", "word", "n")
            .mapInArrow(expect, "lang int, piece int, n double")
            .groupBy("lang", "piece")
            .agg(F.sum("n").alias("n"))
        )
        # Bounded by the vocabulary: a number for each language and piece.
        fitted = np.full((len(languages), size), SMOOTHING)
        for r in counts.collect():
            fitted[r["lang"], r["piece"]] += r["n"]
        chance = fitted / fitted.sum(axis=1, keepdims=True)
    return LanguageModel(languages, chance, path)


def _add_expected(total, words, langs, times, known: Pieces, chance) -> None:
    """Add how often each piece is expected in words of their languages."""
    logs = np.log(chance)
    for some in _batches(words):
        part = [words[i] for i in some]
        length = np.array([len(w) for w in part])
        word, end, n, number = known.within(part, 0, int(length[0]))
        lang = langs[some][word]
        weight = logs[lang, number]
        base = np.concatenate([[0], np.cumsum(length + 1)])  # a place before each character
        after = base[word] + end
        before = after - n
        ahead, back = np.full((2, base[-1]), -np.inf)
        ahead[base[:-1]] = back[base[:-1] + length] = 0.0
        ring = known.longest + 1
        for run in _runs(end * ring + n):
            to = after[run]
            ahead[to] = np.logaddexp(ahead[to], ahead[before[run]] + weight[run])
        for run in _runs((n - end) * ring + n):
            to = before[run]
            back[to] = np.logaddexp(back[to], back[after[run]] + weight[run])
        whole = ahead[base[:-1] + length]
        share = np.exp(ahead[before] + weight + back[after] - whole[word])
        np.add.at(total, (lang, number), share * times[some][word])


def language(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row of ``docs``.

    Learned from text and language of the rows outside the held-out fold; language, source
    and id are no input of a prediction. Repeated rows get the same result, an empty table
    an empty one.
    """
    model = train(docs.select("doc_id", "text", "lang"), vocabulary=vocabulary)
    held_out = fold(F.col("doc_id"), 4) == 2
    return model.predict(docs).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )
