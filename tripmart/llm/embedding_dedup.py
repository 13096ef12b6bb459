"""Near-duplicate vectors by spherical-cap filters with a structured random code.

After a random rotation a direction is cut into three blocks, each with a small random
code of unit vectors. A filter is one code word from each block; a vector is in it if
the inner product with the joined words exceeds a bound, that is, if it lies in the
filter's cap. Because the product is a sum over blocks, the filters of a vector are listed
by decoding, not by trying all: sums of two blocks that no word of the third can lift over
the bound are cut off. Vectors that share a filter are compared exactly.

The bound follows the number of vectors and their dimension, so that a filter holds about
``OCCUPANCY`` unrelated ones. The filters of a code are not independent, but codes, each
with a rotation of its own, are: how often a pair at the threshold shares no filter of a
code is measured on random pairs, and there are as many codes as bring the chance that it
shares none at all below ``MISS``. Many codes of few words need the fewest filters.

A filter's members are compared in chunks of a bounded size. A pair counts in its first
common filter only, so links are counted without listing them: each chunk gives a number
per vector and enough links to connect what it found connected.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import parked
from tripmart.llm.graph import components

THRESHOLD = 0.9
OCCUPANCY = 256
MISS = 1e-8
MOST_CODES = 256
ROTATIONS = 1 << 27  # bytes of all rotations, which bound the codes of long vectors
WORDS = (2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 40, 48, 64, 80, 96, 128, 160, 192, 256)
SAMPLE_CODES, SAMPLE_PAIRS = 24, 200  # random pairs that a plan is measured on
CHUNK = 1024
BLOCKS = 3
SEED = 20240611


class Plan(NamedTuple):
    """Bound of the products, words in a block's code, and number of codes."""

    bound: float
    words: int
    codes: int


def _bound(dim: int, single: float) -> float:
    """What a random direction's product with a word of norm sqrt(dim) exceeds so often."""
    angles = np.linspace(0, math.pi, 100_001)
    density = np.sin(angles) ** (dim - 2)
    mass = np.concatenate([[0.0], np.cumsum(density[1:] + density[:-1])])
    return math.sqrt(dim) * math.cos(np.interp(single, mass / mass[-1], angles))


def random_pairs(dim: int, count: int, cosine: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of random unit vectors at this cosine."""
    left, side = rng.standard_normal((2, count, dim))
    left /= np.linalg.norm(left, axis=1, keepdims=True)
    side -= (left * side).sum(axis=1, keepdims=True) * left
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return left, cosine * left + math.sqrt(1 - cosine * cosine) * side


def _code_miss(dim: int, bound: float, words: int, codes: int, threshold: float) -> float:
    """The share of pairs at the threshold without a common filter in a code, from above."""
    rng, missed = np.random.default_rng(SEED), 0
    for number in range(codes):
        code = Code(dim, words, number)
        left, right = random_pairs(dim, SAMPLE_PAIRS, threshold, rng)
        for at in range(0, SAMPLE_PAIRS, 50):
            pairs = zip(*(code.filters(x[at : at + 50], bound) for x in (left, right)))
            missed += sum(not len(np.intersect1d(a, b, assume_unique=True)) for a, b in pairs)
    n = codes * SAMPLE_PAIRS
    share = (missed + 1) / (n + 1)
    return share + 2 * math.sqrt(share * (1 - share) / n)


@functools.lru_cache(maxsize=64)
def filter_plan(vectors: int, threshold: float = THRESHOLD, dim: int = 64) -> Plan:
    """A plan by which a pair at the threshold shares no filter less often than ``MISS``.

    Where no plan within the limits does so, filters are made wider, which costs
    comparisons but loses nothing; at last one filter holds all.
    """
    most = max(12, min(MOST_CODES, ROTATIONS // (8 * dim * dim)))
    single = min(0.25, OCCUPANCY / max(1, vectors))
    while dim > 1 and 0 < threshold <= 1 and single < 0.5:
        bound = _bound(dim, single)
        # A block of one dimension has two words only.
        for words in WORDS if dim >= 2 * BLOCKS else WORDS[:1]:
            miss = _code_miss(dim, bound, words, min(SAMPLE_CODES, most), threshold)
            codes = math.ceil(math.log(MISS) / math.log(miss)) if miss < 1 else most + 1
            if codes <= most:
                return Plan(bound, words, codes)
        single *= 2
    return Plan(-math.inf, 1, 1)


class Code:
    """A rotation and its block codes, the same wherever they are made."""

    def __init__(self, dim: int, words: int, number: int) -> None:
        rng = np.random.default_rng([SEED, number])
        self.first = number * words**BLOCKS  # number of its first filter
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cuts = np.array_split(np.arange(dim), min(BLOCKS, dim))
        self.words = words
        self.codes = []
        for cut in self.cuts:
            code = rng.standard_normal((words, len(cut)))
            code /= np.linalg.norm(code, axis=1, keepdims=True)
            self.codes.append(code * math.sqrt(len(cut)))

    def filters(self, units: np.ndarray, bound: float) -> list[np.ndarray]:
        """For each unit vector the numbers of all filters whose bound it exceeds."""
        rotated = units @ self.rotation
        # Blocks weigh by their dimension, so the joined word has the norm sqrt(dim) and
        # the sum is about a standard normal for a random direction.
        parts = [rotated[:, cut] @ code.T for cut, code in zip(self.cuts, self.codes)]
        sums, rows = parts[0], np.repeat(np.arange(len(units)), self.words)
        value, number = sums.ravel(), np.tile(np.arange(self.words), len(units))
        for i, part in enumerate(parts[1:], 1):
            rest = sum((p.max(axis=1) for p in parts[i + 1 :]), np.zeros(len(units)))
            wide = value[:, None] + part[rows]
            at, word = np.nonzero(wide > (bound - rest[rows])[:, None])
            value, number, rows = (
                wide[at, word],
                number[at] * self.words + word,
                rows[at],
            )
        order = np.lexsort((number, rows))
        ends = np.searchsorted(rows[order], np.arange(1, len(units)))
        return np.split(self.first + number[order], ends)


def _prepared(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Id, packed vector and its key; both null where a vector cannot be compared."""
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_vector"))
    id_type = rows.schema["_id"].dataType.simpleString()
    kind = np.float32 if "float" in rows.schema["_vector"].dataType.simpleString() else np.float64

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, keys = [], []
            for value in batch.column(1):
                flat = value.values if value.is_valid else None
                good = flat is not None and len(flat) and not flat.null_count
                if good:
                    x = flat.to_numpy(zero_copy_only=False).astype(kind) + kind(0)
                    norm = np.linalg.norm(x.astype(np.float64))
                    good = np.isfinite(norm) and norm > 0
                packed.append(x.tobytes() if good else None)
                keys.append(hashlib.md5(packed[-1]).digest() if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary()), pa.array(keys, pa.binary())],
                ["_id", "packed", "vector_key"],
            )

    return rows.mapInArrow(pack, f"_id {id_type}, packed binary, vector_key binary"), kind


def _units(packed: list[bytes], kind) -> np.ndarray:
    x = np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _filter_rows(kind, plans: dict[int, Plan], width: str):
    """A row for each class and filter that it is in, with its filters before that along."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, list[Code]] = {}
        for batch in batches:
            by_dim: dict[int, list[int]] = {}
            packed = batch.column(1).to_pylist()
            for i, p in enumerate(packed):
                by_dim.setdefault(len(p), []).append(i)
            for size, all_rows in by_dim.items():
                dim = size // np.dtype(kind).itemsize
                bound, words, many = plans[size]
                if size not in codes:
                    codes[size] = [Code(dim, words, number) for number in range(many)]
                step = max(16, min(512, (1 << 22) // words**2))
                for at in range(0, len(all_rows), step):
                    some = np.array(all_rows[at : at + step])
                    units = _units([packed[i] for i in some], kind)
                    by_code = [code.filters(units, bound) for code in codes[size]]
                    found = [np.concatenate(one) for one in zip(*by_code)]
                    counts = [len(f) for f in found]
                    where = pa.array(np.repeat(some, counts))
                    lists = [f.astype(width) for f in found]
                    # Numbers rise along the list, so those before a filter are its start.
                    earlier = [f[:i].tobytes() for f in lists for i in range(len(f))]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(found).astype(np.int64)),
                            pa.array([dim] * len(where), pa.int32()),
                            batch.column(0).take(where),
                            batch.column(1).take(where),
                            batch.column(2).take(where),
                            pa.array(earlier, pa.binary()),
                        ],
                        ["filter", "dim", "cid", "packed", "copies", "earlier"],
                    )

    return rows


def _connecting(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what a matrix of links connects."""
    left, edges = set(range(len(adjacent))), []
    while left:
        front = [left.pop()]
        while front:
            node = front.pop()
            for other in np.flatnonzero(adjacent[node]):
                if other in left:
                    left.discard(other)
                    edges.append((node, int(other)))
                    front.append(int(other))
    return edges


def _compare(kind, threshold: float, width: str):
    """Links among the members of one filter chunk, or between those of two."""

    def compare(key, table):
        cids = table.column("cid").to_numpy()
        units = _units(table.column("packed").to_pylist(), kind)
        weights = table.column("copies").to_numpy()
        part = table.column("part").to_numpy()
        links = units @ units.T >= threshold
        np.fill_diagonal(links, False)
        if key[2].as_py() != key[3].as_py():
            links &= part[:, None] != part[None, :]
        some = np.flatnonzero(links.any(axis=1))
        nodes, counts, edges = [], [], []
        if len(some):
            links = links[np.ix_(some, some)]
            packed = table.column("earlier").to_pylist()
            # Common filters with a smaller number: there such a pair has been counted.
            earlier = [np.frombuffer(packed[i], width) for i in some]
            known, column = np.unique(np.concatenate(earlier), return_inverse=True)
            member = np.zeros((len(some), len(known)), np.float32)
            member[np.repeat(np.arange(len(some)), [len(x) for x in earlier]), column] = 1
            first = links & (member @ member.T == 0)
            nodes = cids[some].tolist()
            counts = (first @ weights[some]).tolist()
            edges = [(int(cids[some[i]]), int(cids[some[j]])) for i, j in _connecting(links)]
        return pa.table(
            {
                "node": pa.array(nodes + [None] * len(edges), pa.int64()),
                "links": pa.array(counts + [None] * len(edges), pa.int64()),
                "a": pa.array([None] * len(nodes) + [e[0] for e in edges], pa.int64()),
                "b": pa.array([None] * len(nodes) + [e[1] for e in edges], pa.int64()),
            }
        )

    return compare


def vector_groups(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Vectors are linked at a cosine of the threshold and more, in double precision. A
    vector that is null, zero, empty or has a null or non-finite component is linked with
    nothing, as are vectors of different lengths. Equal vectors are compared once and
    count as linked with each other; rows that repeat an id are vectors of their own. The
    component is the smallest id that links reach. An empty table gives an empty result.
    """
    prepared, kind = _prepared(vectors, id_col, vector_col)
    rows = parked(prepared, "vectors")
    classes = parked(
        rows.where("vector_key is not null")
        .groupBy("vector_key")
        .agg(
            F.min("_id").alias("first_id"),
            F.count(F.lit(1)).alias("copies"),
            F.min("packed").alias("packed"),
        )
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    sizes = classes.groupBy(F.length("packed").alias("size")).count().collect()
    item = np.dtype(kind).itemsize
    plans = {r["size"]: filter_plan(r["count"], threshold, r["size"] // item) for r in sizes}
    numbers = max((p.codes * p.words**BLOCKS for p in plans.values()), default=0)
    width = "<i4" if numbers < 1 << 31 else "<i8"
    placed = classes.select("cid", "packed", "copies").mapInArrow(
        _filter_rows(kind, plans, width),
        "filter bigint, dim int, cid bigint, packed binary, copies bigint, earlier binary",
    )
    # A filter with many members becomes chunks; each pair of chunks is a group.
    sizes = parked(
        placed.groupBy("filter", "dim").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes"
    )
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    part = F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int")
    grouped = (
        placed.join(sizes, ["filter", "dim"])
        .withColumn("chunks", chunks)
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("lo", F.least("part", "other"))
        .withColumn("hi", F.greatest("part", "other"))
        .select("filter", "dim", "lo", "hi", "part", "cid", "packed", "copies", "earlier")
    )
    found = parked(
        grouped.groupBy("filter", "dim", "lo", "hi").applyInArrow(
            _compare(kind, threshold, width), "node bigint, links bigint, a bigint, b bigint"
        ),
        "found",
    )
    counts = found.where("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    stars = components(found.where("node is null").select("a", "b")).withColumnRenamed(
        "node", "star"
    )
    known = parked(
        classes.select("cid", "vector_key", "first_id", "copies")
        .join(counts, F.col("cid") == F.col("node"), "left")
        .join(stars, F.col("cid") == F.col("star"), "left")
        .select(
            "vector_key",
            "first_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "cid").alias("component"),
        ),
        "known",
    )
    names = parked(known.groupBy("component").agg(F.min("first_id").alias("least")), "names")
    labels = parked(known.join(names, "component").select("vector_key", "n_links", "least"), "labels")
    component = F.when(F.col("vector_key").isNull(), F.col("_id")).otherwise(F.col("least"))
    return (
        rows.select("_id", "vector_key")
        .join(labels, "vector_key", "left")
        .select(
            F.col("_id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.col("_id").eqNullSafe(component).alias("kept"),
        )
    )
