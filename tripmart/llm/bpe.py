"""BPE encoding and decoding through distinct words.

The tokenizer never looks across white space, and between white space only at one run of
letters, digits or signs at a time: these are the words here. Each task splits its
documents and writes, for blocks of documents, every document as a list of codes and the
block's distinct words, dealt to buckets by hash and packed in sorted order. A bucket holds
its words of all blocks: each is encoded once, and the ids go back to the blocks in the
same packing. There the ids are put at the positions of the codes and meet their pieces in
a map-side join: its small side is the fixed vocabulary, an array with the id as index.

Only packed distinct words and their ids are shuffled, no text and no positions: the lists
of codes stay in the bucket files they were written to, and a block's words, a bounded
number, meet them there. A word that every block has is one entry a block, not a group.
"""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import utf8
from tripmart.runtime import fresh_folder

BLOCK_WORDS = 1_500_000  # words of a block's documents before the next block begins

# The tokenizer's pattern between white space, and the characters for which
# lower case, composition and classes are the same in every library. Other stretches of
# text, and those that may hold a special token, are left to the tokenizer whole.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
PLAIN = re.compile(r"[\x21-\x7e\u00c0-\u012f\u0131-\u017f]*\Z")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _packed(codes) -> bytes:
    """Codes by byte planes: the high bytes are mostly zero and compress away."""
    return np.array(codes, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4")[:, 0]


class _Codes(dict):
    """Codes of the words in a stretch between white space, by the stretch's bytes."""

    def __init__(self) -> None:
        super().__init__()
        self.words: dict[str, int] = {}

    def __missing__(self, stretch: bytes) -> list[int]:
        text = stretch.decode()
        if PLAIN.match(text) and "<|" not in text:
            words = PIECES.findall(text.lower())
        else:
            words = [text]
        self[stretch] = codes = [self.words.setdefault(w, len(self.words)) for w in words]
        return codes


def _compressed(planes: bytes) -> bytes:
    return zstandard.compress(planes, 3)


def _dealt(words: list[str], buckets: int) -> tuple[np.ndarray, list[tuple[int, bytes]]]:
    """Words by bucket, sorted and packed; and the codes (positions) in that order."""
    ordered = sorted(range(len(words)), key=words.__getitem__)
    hashes = [xxhash.xxh3_64_intdigest(words[i].encode()) for i in ordered]
    bucket = (np.array(hashes, np.uint64) % np.uint64(buckets)).astype(np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    order = np.array(ordered, np.int64)[by_bucket]
    used, starts = np.unique(bucket[by_bucket], return_index=True)
    packed = []
    for number, part in zip(used.tolist(), np.split(order, starts[1:])):
        packed.append((number, _compressed("\n".join([words[i] for i in part]).encode())))
    return order, packed


def _splitter(buckets: int):
    """Rows of a block: its documents as codes, the order of its words, and the words."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lists, codes, n_words, n_blocks, id_type = [], [], _Codes(), 0, 0, None
        task = TaskContext.get().partitionId()

        def block() -> pa.RecordBatch:
            order, packed = _dealt(list(codes.words), buckets)
            n, m = len(ids), len(packed)
            listed = [_compressed(_packed(order))]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 32 | n_blocks] * (n + 1 + m), pa.int64()),
                    pa.array(ids + [None] * (1 + m), id_type),
                    pa.array(lists + [None] * (1 + m), pa.binary()),
                    pa.array([None] * n + listed + [None] * m, pa.binary()),
                    pa.array([None] * (n + 1) + [p[0] for p in packed], pa.int32()),
                    pa.array([None] * (n + 1) + [p[1] for p in packed], pa.binary()),
                ],
                ["block", "_id", "codes", "word_order", "bucket", "words"],
            )

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                here = list(chain.from_iterable([codes[s] for s in utf8(text).split()]))
                ids.append(key)
                lists.append(_packed(here))
                n_words += len(here)
                if n_words >= BLOCK_WORDS:
                    yield block()
                    ids, lists, codes, n_words, n_blocks = [], [], _Codes(), 0, n_blocks + 1
        if ids:
            yield block()

    return split


def _bucketed(rows: DataFrame) -> DataFrame:
    """``rows`` in bucket files by block, in the shared folder.

    A table for the length of this call only: the frame keeps the files and the buckets.
    """
    spark = rows.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").option(
        "path", f"{fresh_folder(spark, 'blocks')}/table"
    ).option("compression", "zstd").format("parquet").saveAsTable(name)
    kept = spark.table(name)
    kept.schema  # resolved now, while the name is known  # noqa: B018
    spark.sql(f"DROP TABLE {name}")
    return kept


@functools.lru_cache(maxsize=2)
def id_pieces(path: str) -> np.ndarray:
    """The piece of every id: the small side of the id-to-piece join, of fixed size."""
    tokenizer = _tokenizer(path)
    return np.array(
        [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())], object
    )


def encode_words(words: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Packed lengths and ids for packed words (block, bucket, words), a row each.

    A bucket's rows lie together, and each of its words is encoded once.
    """
    path = vocabulary or default_vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, current, known = _tokenizer(path), None, {}
        for batch in batches:
            lengths, lists = [], []
            for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if bucket != current:
                    current, known = bucket, {}
                words = zstandard.decompress(packed).decode().split("\n")
                fresh = [w for w in words if w not in known]
                for at in range(0, len(fresh), 5000):
                    part = fresh[at : at + 5000]
                    found = tokenizer.encode_batch_fast(part, add_special_tokens=False)
                    known.update(zip(part, [e.ids for e in found]))
                ids = [known[w] for w in words]
                lengths.append(_compressed(_packed([len(i) for i in ids])))
                lists.append(_compressed(_packed(list(chain.from_iterable(ids)))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(0),
                    pa.array(lengths, pa.binary()),
                    pa.array(lists, pa.binary()),
                ],
                ["_block", "bucket", "lengths", "ids"],
            )

    return (
        words.select("bucket", "block", "words")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(encode, "_block bigint, bucket int, lengths binary, ids binary")
    )


def _unzipped(part: bytes) -> np.ndarray:
    return _unpacked(zstandard.decompress(part))


def _placer(path: str):
    """The ids and pieces of a block's words at the positions of its documents' codes."""

    def place(docs, words):
        pieces = id_pieces(path)
        codes = docs.column("codes")
        at = pc.is_valid(docs.column("word_order")).to_numpy().argmax()
        order = _unzipped(docs.column("word_order")[at].as_py())
        words = words.sort_by("bucket")  # as the words were dealt
        length, begin = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        flat = np.zeros(0, "<u4")
        if words.num_rows:
            n = np.concatenate([_unzipped(x) for x in words.column("lengths").to_pylist()])
            flat = np.concatenate([_unzipped(x) for x in words.column("ids").to_pylist()])
            length[order] = n
            begin[order] = np.cumsum(n, dtype=np.int64) - n
        tokens, texts, keep = [], [], []
        for row in range(docs.num_rows):
            if row == at:
                continue
            c = _unpacked(codes[row].as_py())
            n = length[c]  # a word that is dropped whole has none
            ends = np.cumsum(n)
            where = np.repeat(begin[c] - ends + n, n) + np.arange(ends[-1] if len(c) else 0)
            mine = flat[where]
            keep.append(row)
            tokens.append(mine.tobytes())
            texts.append(" ".join(pieces[mine].tolist()))
        return pa.table(
            {
                "_id": docs.column("_id").take(pa.array(keep, pa.int64())),
                "tokens": pa.array(tokens, pa.binary()),
                "decoded": pa.array(texts, pa.string()),
            }
        )

    return place


def encode_decode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
) -> DataFrame:
    """Id, ``tokens`` (ids as little-endian unsigned 32-bit integers) and ``decoded`` text.

    As the tokenizer encodes a text without adding special tokens, and decodes with
    them. A null text is an empty one: no tokens, an empty decoded text. Repeated rows
    give repeated results, an empty table none; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _bucketed(
        rows.mapInArrow(
            _splitter(buckets),
            f"block bigint, _id {id_type}, codes binary, word_order binary, bucket int, "
            "words binary",
        )
    )
    words = blocks.where("bucket is not null").select("block", "bucket", "words")
    encoded = encode_words(words, vocabulary)
    return (
        blocks.where("bucket is null")
        .select("block", "_id", "codes", "word_order")
        .groupBy("block")
        .cogroup(encoded.groupBy("_block"))
        .applyInArrow(
            _placer(vocabulary or default_vocabulary()),
            f"_id {id_type}, tokens binary, decoded string",
        )
        .withColumnRenamed("_id", id_col)
    )


def token_digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of tokens and digests of tokens and decoded text."""
    return encoded.select(
        id_col,
        F.expr("length(tokens) div 4").cast("long").alias("n_tokens"),
        F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
