"""Importance resampling toward a target distribution, over hashed runs of words.

A dictionary of common words, each between two delimiters, is an Aho-Corasick automaton
whose payloads are the CRC-32 and the length of the word. A scan of a text emits the
payloads of its words in order; what lies between two hits is a word that the dictionary
lacks, and gets its payload computed. The CRC of a run of words follows from those of its
words, since a CRC is linear: no run is ever put together as a string. CRCs modulo the
number of buckets are the features.

The dictionary decides on speed only, so a bounded sample of documents makes it. A first
pass scans every text once and keeps its buckets, two bytes a feature; the totals of both
tables and the scores are taken from there. Only sums by bucket are shuffled, the table of
gains has one number per bucket, and the ranks come from a range partitioning.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import hashed_sample, parked, utf8
from tripmart.operators.numbering import number_rows

GRAMS = 1  # longest run of words
BUCKETS = 10_000
LEAST_WORDS = 20  # of a document that may be drawn
PERCENT = 10  # of these that are drawn
SEED = 2024

# Bounds of the dictionary: words, their longest length in bytes, and the documents that
# they are counted in, whole texts of at most so many characters.
DICTIONARY_WORDS = 50_000
WORD_BYTES = 64
SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 20_000
SCAN_BYTES = 1 << 20  # bytes of a text between two delimiters that are scanned at once
SLICE_BYTES = 8 << 20  # buckets of a batch that leaves a task

# Digits, ASCII letters and all other characters from U+0080 are words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
    else c + 32 if 0x41 <= c <= 0x5A
    else 0x20
    for c in range(256)
)
MASK = 0xFFFFFFFF


@functools.lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """For 2**k zero bytes after a text, what each byte of its CRC turns into."""
    one = [zlib.crc32(b"\0", 1 << bit ^ MASK) ^ MASK for bit in range(32)]
    tables = []
    for _ in range(32):
        table = np.zeros((4, 256), np.uint32)
        for part in range(4):
            for bit in range(8):
                half = 1 << bit
                table[part, half : 2 * half] = table[part, :half] ^ np.uint32(one[8 * part + bit])
        tables.append(table)
        one = _mapped(table, np.array(one, np.uint32)).tolist()
    return np.stack(tables)


def _mapped(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (
        table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]
    )


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32s of texts put together, by those of both and the second's length in bytes."""
    crc, left, k = first.astype(np.uint32), length.astype(np.int64), 0
    while left.any():
        odd = (left & 1).astype(bool)
        crc[odd] = _mapped(_shifts()[k], crc[odd])
        left, k = left >> 1, k + 1
    return crc ^ second


class Scanner:
    """CRCs and lengths of a text's words, by an automaton over delimited words."""

    def __init__(self, words: list[bytes]) -> None:
        self.automaton = ahocorasick.Automaton()
        for code, word in enumerate(words):
            self.automaton.add_word(f" {word.decode('latin-1')} ", code)
        if words:
            self.automaton.make_automaton()
        self.crcs = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.lengths = np.array([len(w) for w in words], np.int64)

    def payloads(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """A very long text is scanned in pieces that end at a delimiter."""
        folded, crcs, lengths, begin = text.translate(FOLD), [], [], 0
        while begin < len(folded):
            end = folded.find(b" ", begin + SCAN_BYTES)
            end = len(folded) if end < 0 else end
            crc, length = self._scan(b" %b " % folded[begin:end])
            crcs.append(crc)
            lengths.append(length)
            begin = end
        if not crcs:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(crcs), np.concatenate(lengths)

    def _scan(self, piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        hits = self.automaton.iter(piece.decode("latin-1")) if len(self.crcs) else ()
        found = np.array(list(hits), np.int64).reshape(-1, 2)
        ends, codes = found[:, 0], found[:, 1]
        crc, length = self.crcs[codes], self.lengths[codes]
        if length.sum() == len(piece) - piece.count(b" "):
            return crc, length
        # Where more than the delimiter lies between two hits there may be other words.
        begin, stop = np.append(0, ends), np.append(ends - length, len(piece))
        at, own, sizes = [], [], []
        for gap in np.flatnonzero(stop - begin > 1).tolist():
            for word in piece[begin[gap] : stop[gap]].split():
                at.append(gap)
                own.append(zlib.crc32(word))
                sizes.append(len(word))
        return np.insert(crc, at, np.array(own, np.uint32)), np.insert(length, at, sizes)


@functools.lru_cache(maxsize=2)
def scanner(words: tuple[bytes, ...]) -> Scanner:
    return Scanner(list(words))


def composed(crc: np.ndarray, length: np.ndarray, grams: int, buckets: int) -> np.ndarray:
    """The buckets of all runs of up to ``grams`` words, shorter runs first."""
    space, one = np.uint32(zlib.crc32(b" ")), np.ones(1, np.int64)
    runs, out = crc, [crc % np.uint32(buckets)]
    for n in range(2, grams + 1):
        if len(crc) < n:
            break
        runs = joined_crc(runs[:-1], space, np.broadcast_to(one, len(runs) - 1))
        runs = joined_crc(runs, crc[n - 1 :], length[n - 1 :])
        out.append(runs % np.uint32(buckets))
    return np.concatenate(out)


def common_words(docs: DataFrame, id_col: str, text_col: str) -> tuple[bytes, ...]:
    """The most frequent words of a bounded sample, chosen by a hash of the id."""
    sample = hashed_sample(docs, id_col, text_col, SAMPLE_DOCS, SAMPLE_CHARS).select(
        F.translate("text", UPPER, LOWER).alias("text")
    )
    rows = (
        sample.select(F.explode(F.regexp_extract_all("text", F.lit(WORD_PATTERN), 0)).alias("word"))
        .where(F.octet_length("word") <= WORD_BYTES)
        .groupBy("word")
        .count()
        .orderBy(F.desc("count"), "word")
        .limit(DICTIONARY_WORDS)
        .collect()
    )
    return tuple(r.word.encode() for r in rows)


def hashed_features(
    docs: DataFrame,
    words: tuple[bytes, ...],
    id_col: str = "doc_id",
    text_col: str = "text",
    grams: int = GRAMS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``_id``, ``n_words``, ``n_features`` and the packed ``buckets`` of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    kind = _kind(buckets)
    known = docs.sparkSession.sparkContext.broadcast(words)  # at most DICTIONARY_WORDS

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan_words = scanner(known.value)
        for batch in batches:
            begin, held, size = 0, [], 0
            for at, text in enumerate(batch.column(1), 1):
                crc, length = scan_words.payloads(utf8(text))
                found = composed(crc, length, grams, buckets)
                held.append((len(crc), len(found), found.astype(kind).tobytes()))
                size += len(held[-1][2])
                if size >= SLICE_BYTES or at == batch.num_rows:
                    n_words, n_features, packed = zip(*held)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(begin, at - begin),
                            pa.array(n_words, pa.int64()),
                            pa.array(n_features, pa.int64()),
                            pa.array(packed, pa.binary()),
                        ],
                        ["_id", "n_words", "n_features", "buckets"],
                    )
                    begin, held, size = at, [], 0

    schema = f"_id {id_type}, n_words bigint, n_features bigint, buckets binary"
    return rows.mapInArrow(scan, schema)


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and the number ``n`` of features in it; a task adds up its own first."""
    kind = _kind(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(utf8(packed), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    parts = features.select("buckets").mapInArrow(count, "bucket bigint, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(
    features: DataFrame, target: DataFrame, buckets: int = BUCKETS
) -> np.ndarray:
    """A thousand times the logarithm of how much likelier each bucket is in the target.

    Both shares are smoothed by one feature a bucket. One number per bucket.
    """
    spark = features.sparkSession
    every = (
        spark.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(bucket_counts(features, buckets).withColumnRenamed("n", "s"), "bucket", "left")
        .join(bucket_counts(target, buckets).withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")])
        .collect()
    )
    every.sort(key=lambda r: r.bucket)
    s, t = (np.array([r[c] for r in every]) for c in ("s", "t"))
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(features: DataFrame, gains: np.ndarray, id_col: str) -> DataFrame:
    """Id, ``n_words``, ``n_features`` and the sum of the gains of its features."""
    kind = _kind(len(gains))
    id_type = features.schema["_id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(gains[np.frombuffer(utf8(p), kind)].sum()) for p in batch.column(3)]
            columns = [*batch.columns[:3], pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "n_words", "n_features", "weight"])

    return features.mapInArrow(
        weigh, f"_id {id_type}, n_words bigint, n_features bigint, weight bigint"
    ).withColumnRenamed("_id", id_col)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    grams: int = GRAMS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Every document's id, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    The score is the weight with Gumbel noise of the id, so the best are a draw without
    replacement by importance weight. ``percent`` of the documents with ``least_words``
    are drawn and ranked from 1; ties go to the smaller id (a null id last), then to fewer
    features and the lower weight. A null text has no words, and a document without
    features the weight 0. A null id has the noise of an empty one. Repeated rows are rows
    of their own with the same score. An empty target leaves only the smoothing, an empty
    table gives an empty result.
    """
    words = common_words(docs, id_col, text_col)
    shared = {"grams": grams, "buckets": buckets}
    features = parked(hashed_features(docs, words, id_col, text_col, **shared), "features")
    aim = target.select(F.lit(0).alias("id"), F.col(f"`{target_text_col}`").alias("text"))
    aimed = hashed_features(aim, words, "id", "text", **shared)
    gains = bucket_gains(features, aimed, buckets)
    noise = F.expr(
        f"conv(substring(sha2(concat('{seed}:', coalesce(cast(`{id_col}` AS string), '')), 256), "
        "1, 8), 16, 10)"
    ).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((noise + 0.5) / F.lit(float(1 << 32)))))
    scored = parked(
        weights(features, gains, id_col).withColumn("score", F.col("weight") + gumbel), "scored"
    )
    able = scored.where(F.col("n_words") >= least_words)
    most = able.count() * percent // 100
    order = [
        F.desc("score"), F.col(f"`{id_col}`").asc_nulls_last(), F.asc("n_features"), F.asc("weight")
    ]
    ranked = number_rows(able, order, "rank").withColumn(
        "rank", F.when(F.col("rank") <= most, F.col("rank"))
    )
    rest = scored.where(F.col("n_words") < least_words)
    return ranked.unionByName(rest.withColumn("rank", F.lit(None).cast("long"))).select(
        id_col, "n_words", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank")
    )
