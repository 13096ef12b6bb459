"""Token ids in binary shard files, each document compressed with a shared dictionary.

A zstandard dictionary is trained once on the serialized ids of a bounded sample. Every
document is then encoded and compressed on its own with it, the rows are range-partitioned
by id, and each task packs its documents, in order, into shards of a bounded size. A shard
is one file: header, frames, an index and a footer, so that a reader gets one document
with three short reads. Spark's own writer commits the files, so any store that Spark can
write will do, and a task that is run again leaves nothing behind.

Layout of a shard, integers little-endian::

    8 bytes   magic            32 bytes  SHA-256 of the dictionary    4 bytes  id width
    ...       zstandard frames, one per document: ids of 2 or 4 bytes each
    ...       index: zstandard-compressed Arrow stream of id, offset, size, n_tokens
    8, 8, 8   offset and size of the index, number of documents       8 bytes  magic
    1 byte    line feed, which Spark's text writer puts after every row

The ids are those of the tokenizers library. It encodes texts with a special token's string
or very long white space; all others go through tiktoken with the same vocabulary, which
gives the same ids at a quarter of the cost. The tests compare both for every code point.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs as store
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import hashed_sample, parked, utf8
from tripmart.runtime import file_system
from tripmart.sources.headers import opened

END_ID = 2  # appended to every document
SHARD_BYTES = 32 << 20  # a shard is closed once its frames are as long
SAMPLE_DOCS = 512  # documents that train the dictionary, and their longest text
SAMPLE_CHARS = 8_192
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
SLICE_BYTES = 8 << 20  # compressed frames of a batch that leaves a task
READ_BYTES = 1 << 20  # of a shard that are read at once, but for longer frames
ROW_BYTES = 64  # a row without its tokens, about

MAGIC = b"TOKSHRD1"
HEADER = struct.Struct("<8s32sI")
FOOTER = struct.Struct("<QQQ8s")
LONG_SPACE = re.compile(r"\s{1000}")  # tiktoken's pattern recurses over white space
MANIFEST = "shard string, first string, last string, documents long, tokens long, bytes long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_ranks() -> str:
    """The default vocabulary once more, as tiktoken reads it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """The ids of texts in a byte-level vocabulary, without special tokens added."""

    def __init__(self, vocabulary: str, ranks: str | None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = self._compiled(ranks) if ranks else None

    @staticmethod
    def _compiled(ranks: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            pieces = {base64.b64decode(p): int(r) for p, r in map(bytes.split, lines)}
        return tiktoken.Encoding(
            "shared", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pieces, special_tokens={}
        )

    def ids(self, text: str) -> list[int]:
        if self.fast and not (
            any(s in text for s in self.special) or len(text) >= 1000 and LONG_SPACE.search(text)
        ):
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str, ranks: str | None) -> Encoder:
    return Encoder(vocabulary, ranks)


def id_width(largest: int) -> int:
    """Bytes of a stored id."""
    return 2 if largest < 1 << 16 else 4


def serialized(ids: list[int], width: int) -> bytes:
    return np.array(ids, f"<u{width}").tobytes()


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def trained_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for arrays like the samples.

    Samples too few or too alike to train on are taken as they are; without any there is
    no dictionary, and its bytes are none.
    """
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:size]


def train(
    docs: DataFrame, id_col: str, text_col: str, vocabulary: str, ranks: str | None, end_id: int
) -> bytes:
    """The dictionary of a table, at most ``DICTIONARY_BYTES`` long.

    Trained in one task on whole texts of up to ``SAMPLE_CHARS`` characters of
    ``SAMPLE_DOCS`` documents, chosen by a hash of the id. It decides on sizes only.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, samples = encoder(vocabulary, ranks), []
        width = id_width(max(code.size, end_id + 1) - 1)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                samples.append(serialized([*code.ids(text), end_id], width))
        data = trained_dictionary(samples)
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    sample = hashed_sample(docs, id_col, text_col, SAMPLE_DOCS, SAMPLE_CHARS)
    rows = sample.repartition(1).mapInArrow(fit, "data binary").collect()
    return max((bytes(r.data) for r in rows), default=b"", key=len)


def compressed_documents(
    docs: DataFrame,
    dictionary: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    ranks: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """``_id``, ``n_tokens``, ``crc`` of the stored ids and the zstandard ``frame`` of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary, ranks)
        width = id_width(max(code.size, end_id + 1) - 1)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        for batch in batches:
            begin, counts, crcs, frames, held = 0, [], [], [], 0
            for at, text in enumerate(batch.column(1), 1):
                stored = serialized([*code.ids(utf8(text).decode()), end_id], width)
                counts.append(len(stored) // width)
                crcs.append(zlib.crc32(stored))
                frames.append(press.compress(stored))
                held += len(frames[-1])
                if held >= SLICE_BYTES or at == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(begin, at - begin),
                            pa.array(counts, pa.int64()),
                            pa.array(crcs, pa.int64()),
                            pa.array(frames, pa.binary()),
                        ],
                        ["_id", "n_tokens", "crc", "frame"],
                    )
                    begin, counts, crcs, frames, held = at, [], [], [], 0

    return rows.mapInArrow(compress, f"_id {id_type}, n_tokens bigint, crc bigint, frame binary")


class _Packer:
    """The documents of one shard, and the bytes of its file."""

    def __init__(self, digest: bytes, width: int) -> None:
        self.parts, self.at = [HEADER.pack(MAGIC, digest, width)], HEADER.size
        self.keys, self.offsets, self.sizes, self.counts = [], [], [], []

    def add(self, key: pa.Array, count: int, frame: bytes) -> None:
        self.keys.append(key)
        self.offsets.append(self.at)
        self.sizes.append(len(frame))
        self.counts.append(count)
        self.parts.append(frame)
        self.at += len(frame)

    def file(self) -> bytes:
        table = pa.table(
            {
                "id": pa.concat_arrays(self.keys),
                "offset": pa.array(self.offsets, pa.int64()),
                "size": pa.array(self.sizes, pa.int64()),
                "n_tokens": pa.array(self.counts, pa.int64()),
            }
        )
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table.schema) as stream:
            stream.write_table(table)
        index = zstandard.compress(out.getvalue().to_pybytes(), LEVEL)
        footer = FOOTER.pack(self.at, len(index), len(self.counts), MAGIC)
        return b"".join([*self.parts, index, footer])

    def line(self, shard: str, size: int) -> bytes:
        """The shard's line of the manifest."""
        ends = [self.keys[0][0].as_py(), self.keys[-1][0].as_py()]
        first, last = (None if key is None else str(key) for key in ends)
        row = {"shard": shard, "first": first, "last": last, "documents": len(self.counts),
               "tokens": sum(self.counts), "bytes": size}
        return json.dumps(row).encode()


def pack_shards(ordered: DataFrame, dictionary: bytes, width: int, shard_bytes: int) -> DataFrame:
    """``kind``, ``shard``, ``data``: files of the rows as they lie, and their manifest lines."""
    digest = hashlib.sha256(dictionary).digest()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, packer = TaskContext.get().partitionId(), 0, _Packer(digest, width)

        def closed() -> pa.RecordBatch:
            shard, data = f"{task:08d}-{number:06d}", packer.file()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(["shards", "manifest"]),
                    pa.array([shard, "lines"]),
                    pa.array([data, packer.line(shard, len(data))], pa.binary()),
                ],
                ["kind", "shard", "data"],
            )

        for batch in batches:
            keys, counts, frames = (batch.column(i) for i in range(3))
            for i in range(batch.num_rows):
                packer.add(keys.slice(i, 1), counts[i].as_py(), frames[i].as_py())
                if packer.at >= shard_bytes:
                    yield closed()
                    number, packer = number + 1, _Packer(digest, width)
        if packer.counts:
            yield closed()

    return ordered.select("_id", "n_tokens", "frame").mapInArrow(
        pack, "kind string, shard string, data binary"
    )


def write_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    ranks: str | None = None,
    end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Write the ids of all texts below ``path``, which must not exist, by ascending id.

    A null text is an empty one and has the end id alone. A null id comes first; rows with
    the same id come by number of tokens and checksum, equal rows one after the other. A
    very long text is one frame, alone in its shard if need be. An empty table has a
    dictionary and no shard. Other columns are not read.
    """
    spark = docs.sparkSession
    if vocabulary is None:
        vocabulary, ranks = default_vocabulary(), ranks or default_ranks()
    dictionary = train(docs, id_col, text_col, vocabulary, ranks, end_id)
    spark.createDataFrame([(bytearray(dictionary),)], "data binary").coalesce(1).select(
        F.col("data").cast("string")
    ).write.text(f"{path}/dictionary")
    frames = parked(
        compressed_documents(docs, dictionary, id_col, text_col, vocabulary, ranks, end_id),
        "frames",
    )
    # The last key tells equal rows apart, so that they can lie in several partitions.
    order = ["_id", "n_tokens", "crc", "_row"]
    ordered = (
        frames.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    width = id_width(max(encoder(vocabulary, None).size, end_id + 1) - 1)
    (
        pack_shards(ordered, dictionary, width, shard_bytes)
        .select("kind", "shard", F.col("data").cast("string"))
        .write.partitionBy("kind", "shard")
        .text(f"{path}/files")
    )


class Shard:
    """One shard file, by a function that reads a number of bytes at an offset.

    ``dictionaries`` are dictionary bytes by their SHA-256, as the header names them.
    """

    def __init__(
        self, read: Callable[[int, int], bytes], size: int, dictionaries: dict[bytes, bytes]
    ) -> None:
        magic, digest, self.width = HEADER.unpack(read(0, HEADER.size))
        at, length, self.documents, end = FOOTER.unpack(read(size - 1 - FOOTER.size, FOOTER.size))
        if magic != MAGIC or end != MAGIC:
            raise ValueError("not a shard of tokens")
        if digest not in dictionaries:
            raise ValueError(f"the shard needs the dictionary {digest.hex()}")
        self.read = read
        self.plain = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionaries[digest]))
        with pa.ipc.open_stream(zstandard.decompress(read(at, length))) as stream:
            self.index = stream.read_all().combine_chunks()
        self.offsets, self.sizes = (self.index[c].to_numpy() for c in ("offset", "size"))

    def ids(self, row: int) -> np.ndarray:
        """The ids of the document in that row of the index."""
        frame = self.read(int(self.offsets[row]), int(self.sizes[row]))
        return np.frombuffer(self.plain.decompress(frame), f"<u{self.width}")

    def find(self, key) -> list[np.ndarray]:
        """The ids of every document with that id."""
        rows = np.flatnonzero(pc.equal(self.index["id"], key).fill_null(False))
        return [self.ids(int(r)) for r in rows]


def read_ahead(
    read: Callable[[int, int], bytes], size: int, piece: int = READ_BYTES
) -> Callable[[int, int], memoryview]:
    """``read`` of a file by pieces: frames one after the other need few reads."""
    begin, held = 0, memoryview(b"")

    def ahead(at: int, n: int) -> memoryview:
        nonlocal begin, held
        if not begin <= at <= at + n <= begin + len(held):
            begin, held = at, memoryview(read(at, min(max(n, piece), size - at)))
        return held[at - begin : at - begin + n]

    return ahead


def reads_ranges(path: str) -> bool:
    """Whether Arrow opens the store of a folder, so that tasks need not get whole files."""
    try:
        files, folder = opened(path)
        return files.get_file_info(folder).type == store.FileType.Directory
    except (OSError, ValueError, NotImplementedError):
        return False


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    """The dictionary, at most ``DICTIONARY_BYTES``, without the writer's line feed."""
    (file,) = spark.read.format("binaryFile").load(f"{path}/dictionary").select("content").collect()
    return bytes(file.content)[:-1]


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row for each shard, with ``start``: the tokens of all shards before it."""
    lines = spark.read.schema(MANIFEST).json(f"{path}/files/kind=manifest/shard=lines")
    # One row for each shard of ``SHARD_BYTES``, in one task.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_tokens(
    spark: SparkSession,
    path: str,
    id_col: str = "doc_id",
    id_type: str = "bigint",
    tokens: bool = True,
) -> DataFrame:
    """All documents of the shards: id, ``start``, ``n_tokens``, ``ids_crc32`` and ``tokens``.

    ``start`` counts the ids of all documents before, ``ids_crc32`` is taken over the ids
    as little-endian unsigned 32-bit integers, as ``tokens`` (left out on demand) holds them.
    A task reads its shards by pieces of ``READ_BYTES``; where Arrow does not know the store,
    Spark hands it one whole shard after the other.
    """
    schema = f"shard string, _id {id_type}, _before bigint, n_tokens bigint, ids_crc32 bigint"
    schema += ", tokens binary" if tokens else ""
    if not _has_shards(spark, path):
        empty = spark.createDataFrame([], schema)
        return empty.select(
            F.col("_id").alias(id_col),
            F.col("_before").alias("start"),
            *[c for c in empty.columns if c not in ("shard", "_id", "_before")],
        )
    dictionary = read_dictionary(spark, path)
    known = {hashlib.sha256(dictionary).digest(): dictionary}
    ranges = reads_ranges(f"{path}/files/kind=shards")

    @contextlib.contextmanager
    def shard_of(file: pa.Scalar) -> Iterator[Shard]:
        if not ranges:
            data = memoryview(file.as_buffer())
            yield Shard(lambda at, n: data[at : at + n], len(data), known)
            return
        files, name = opened(file.as_py())
        with files.open_input_file(name) as source:
            size = source.size()
            yield Shard(read_ahead(lambda at, n: source.read_at(n, at), size), size, known)

    def rows_of(name: str, shard: Shard) -> Iterator[pa.RecordBatch]:
        keys, before, begin, held = shard.index["id"].combine_chunks(), 0, 0, []
        size = 0
        for row in range(shard.documents):
            ids = shard.ids(row).astype("<u4").tobytes()
            held.append((before, len(ids) // 4, zlib.crc32(ids), ids if tokens else b""))
            before += len(ids) // 4
            size += ROW_BYTES + len(held[-1][3])
            if size >= SLICE_BYTES or row + 1 == shard.documents:
                columns = list(zip(*held))
                n = len(held)
                arrays = [
                    pa.array([name] * n),
                    keys.slice(begin, n),
                    *[pa.array(c, pa.int64()) for c in columns[:3]],
                    *([pa.array(columns[3], pa.binary())] if tokens else []),
                ]
                names = ["shard", "_id", "_before", "n_tokens", "ids_crc32", "tokens"]
                yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])
                begin, held, size = row + 1, [], 0

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, file in zip(batch.column(0).to_pylist(), batch.column(1)):
                with shard_of(file) as shard:
                    yield from rows_of(name, shard)

    files = spark.read.format("binaryFile").load(f"{path}/files/kind=shards")
    file = "path" if ranges else "content"
    rows = files.select(F.col("shard").cast("string"), file).mapInArrow(unpack, schema)
    manifest = read_manifest(spark, path).select("shard", "start")
    return rows.join(manifest, "shard").select(
        F.col("_id").alias(id_col),
        (F.col("start") + F.col("_before")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["tokens"] if tokens else []),
    )


def _has_shards(spark: SparkSession, path: str) -> bool:
    fs, folder = file_system(spark, f"{path}/files/kind=shards")
    return fs.exists(folder)
