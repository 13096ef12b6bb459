"""Near-duplicates by MinHash bands and sequential Bayesian verification.

Texts with the same set of word shingles form one class, so copies cost nothing. Every
class gets a signature of 150 minima; bands of them are keys (25 of six minima at 85
percent, 30 of five at 80), and classes that share a key are candidates. A pair's signatures are compared in batches of 30: after each
the posterior probability that the similarity reaches the threshold (uniform prior, so a
beta distribution) is looked at, and the pair is dropped once it is below ``MISS``. What
survives all 150 is verified on the full texts.

Only connections matter, so a bucket is not turned into all its pairs:

1. Stars: in every bucket each class meets one class, another one in each band and round.
   A component verifies its most promising pairs first, and pairs within a component
   need no look any more. This connects most of a large group by a linear number of pairs.
2. Remainders: in buckets that still hold several components, all classes outside the
   bucket's main one are compared with all classes of other components, in chunks of a
   bounded number of classes. Nothing is skipped but what is connected already, and only
   links come out.

A pair of the least similarity shares a band with a probability above 0.99999.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import parked
from tripmart.llm.graph import components

SHINGLE = 5
HASHES = 150
BATCH = 30
MISS = 1e-5
PERCENT = 85  # a link needs 100 * intersection >= percent * union; this is op8's
STAR_ROUNDS = 2
STAR_BEST = (2, 16)  # pairs a component verifies, in the turns of a round
CHUNK_ALL, CHUNK_FEW = 256, 64

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(20240607)
_MULTIPLY = _RNG.integers(1, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)
_BAND_MIX = _RNG.integers(1, 2**63, 6, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; empty without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    one = xxhash.xxh3_64_intdigest
    hashes = np.array([one(w) for w in words], np.uint64)
    width = min(SHINGLE, len(words))
    ends = len(hashes) - width + 1
    mixed = np.full(ends, width, np.uint64)
    for i in range(width):
        mixed = mixed * _PRIME + hashes[i : ends + i]
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima of 150 hash functions over a set, 32 bits each."""
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 1024):
        mixed = short[at : at + 1024, None] * _MULTIPLY + _ADD
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        mixed ^= mixed >> np.uint32(13)
        np.minimum(best, mixed.min(axis=0), out=best)
    return best


@functools.lru_cache(maxsize=8)
def band_shape(percent: int = PERCENT) -> tuple[int, int]:
    """Bands and rows: the longest bands of which a pair at the threshold shares one.

    It shares none with a probability of at most ``MISS``.
    """
    for rows in (6, 5, 3, 2):
        if (1 - (percent / 100) ** rows) ** (HASHES // rows) <= MISS:
            return HASHES // rows, rows
    return HASHES, 1


@functools.lru_cache(maxsize=8)
def fewest_matches(percent: int = PERCENT, miss: float = MISS) -> tuple[int, ...]:
    """For 30, 60, ... 150 compared minima: the matches below which a pair is dropped.

    With m matches of h the similarity has the posterior Beta(m + 1, h - m + 1). It
    reaches t with the probability that h + 1 draws of chance t give at most m.
    """
    t, least = percent / 100, []
    for h in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(h + 1, m) * t**m * (1 - t) ** (h + 1 - m)
        least.append(m)
    return tuple(least)


def surviving(
    left: np.ndarray, right: np.ndarray, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs (rows of two matrices) that survive, and their matches."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for step, least in enumerate(fewest_matches(percent)):
        part = slice(step * BATCH, (step + 1) * BATCH)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive, matches[alive]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, signatures = [], [], []
        for text in batch.column(1):
            shingles = shingle_set(text.as_py())
            sizes.append(len(shingles))
            keys.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
            signatures.append(signature(shingles).tobytes() if len(shingles) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(signatures, pa.binary()),
                batch.column(2),
            ],
            ["_id", "n_shingles", "set_key", "sig", "_hash"],
        )


def _set_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the key of their shingle set, to find one text of a class again."""
    for batch in batches:
        keys = []
        for text in batch.column(0):
            shingles = shingle_set(text.as_py())
            keys.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), batch.column(0)], ["set_key", "text"]
        )


def _band_keys(
    percent: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    bands, rows = band_shape(percent)
    for batch in batches:
        if not batch.num_rows:
            continue
        minima = _matrix(batch.column(1)).reshape(-1, bands, rows).astype(np.uint64)
        keys = np.arange(1, bands + 1, dtype=np.uint64) * _PRIME + np.zeros(
            (len(minima), 1), np.uint64
        )
        for row in range(rows):
            keys = (keys ^ minima[:, :, row]) * _BAND_MIX[row]
            keys ^= keys >> np.uint64(29)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys.view(np.int64).ravel()),
                pa.array(np.tile(np.arange(bands, dtype=np.int32), len(minima))),
                pa.array(np.repeat(batch.column(0).to_numpy(), bands)),
            ],
            ["key", "band", "cid"],
        )


def _prune(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        alive, matches = surviving(
            _matrix(batch.column(2)), _matrix(batch.column(3)), percent
        )
        where = pa.array(alive)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(where), batch.column(1).take(where), pa.array(matches)],
            ["a", "b", "matches"],
        )


def _bucket_links(percent: int, key, table):
    """Links of a bucket's lesser components: one chunk of them against one chunk of all.

    A pair is looked at in the first band it shares only. For each lesser class one link to
    every other component is enough, the most promising pairs are verified first.
    """
    few_chunk, every_chunk = key[1].as_py(), key[2].as_py()
    band = table.column("band")[0].as_py()
    cid = table.column("cid").to_numpy()
    comp = table.column("comp").to_numpy()
    lesser = table.column("lesser").to_numpy()
    every = table.column("chunk").to_numpy() == every_chunk
    few = np.flatnonzero(lesser & (table.column("few").to_numpy() == few_chunk))
    sig = _matrix(table.column("sig"))
    texts, sets = table.column("text"), {}

    def shingles(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_set(texts[i].as_py())
        return sets[i]

    links = []
    for i in few:
        # Two lesser classes meet once; a main class meets every lesser one.
        other = np.flatnonzero(every & (comp != comp[i]) & (~lesser | (cid > cid[i])))
        same = (sig[other] == sig[i]).reshape(-1, *band_shape(percent)).all(axis=2)
        other = other[same.argmax(axis=1) == band] if len(other) else other
        alive, matches = surviving(
            np.broadcast_to(sig[i], (len(other), HASHES)), sig[other], percent
        )
        rest = other[alive[np.argsort(-matches, kind="stable")]]
        take = 8
        while len(rest):
            now, rest = rest[:take], rest[take:]
            mine, theirs = shingles(i), [shingles(j) for j in now]
            size = np.array([len(x) for x in theirs])
            flat = np.concatenate(theirs)
            at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
            both = np.add.reduceat(mine[at] == flat, np.cumsum(size) - size, dtype=np.int64)
            good = now[100 * both >= percent * (len(mine) + size - both)]
            for j in good[np.unique(comp[good], return_index=True)[1]]:
                links.append((int(cid[i]), int(cid[j])))
            rest, take = rest[~np.isin(comp[rest], comp[good])], 256
    return pa.table(
        {
            "a": pa.array([x[0] for x in links], pa.int64()),
            "b": pa.array([x[1] for x in links], pa.int64()),
        }
    )


def _verify(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: tuple[int | None, np.ndarray | None] = (None, None)
    for batch in batches:
        keep = []
        for a, left, right in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
            if known[0] != a:
                known = (a, shingle_set(left.as_py()))
            one, other = known[1], shingle_set(right.as_py())
            both = len(np.intersect1d(one, other, assume_unique=True))
            keep.append(100 * both >= percent * (len(one) + len(other) - both))
        where = pa.array(np.flatnonzero(keep))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(where), batch.column(1).take(where)], ["a", "b"]
        )


class _Search:
    """Components of classes, grown by verified links until no candidate is left."""

    def __init__(
        self, classes: DataFrame, docs: DataFrame, text_col: str, percent: int = PERCENT
    ) -> None:
        self.classes = classes
        self.percent = percent
        keys = classes.select("cid", "sig").mapInArrow(
            functools.partial(_band_keys, percent), "key bigint, band int, cid bigint"
        )
        shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        self.buckets = parked(keys.join(shared, "key").select("key", "band", "cid"), "buckets")
        self.comps = parked(
            self.buckets.select("cid").distinct().withColumn("comp", F.col("cid")), "comps"
        )
        involved = classes.join(self.comps.select("cid"), "cid")
        self.sigs = parked(involved.select("cid", "sig"), "signatures")
        texts = docs.select(F.col(text_col).alias("text")).mapInArrow(
            _set_keys, "set_key binary, text string"
        )
        # One text of each class that has candidates at all.
        self.texts = parked(
            texts.join(involved.select("set_key", "cid"), "set_key")
            .groupBy("cid")
            .agg(F.min("text").alias("text")),
            "texts",
        )
        self.tested = None

    def mixed(self) -> DataFrame:
        """Rows of the buckets that hold more than one component."""
        rows = self.buckets.join(self.comps, "cid")
        open_keys = (
            rows.groupBy("key")
            .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .where("lo < hi")
            .select("key")
        )
        return parked(rows.join(open_keys, "key").select("key", "band", "cid", "comp"), "mixed")

    def star(self, mixed: DataFrame, turn: int) -> DataFrame:
        """Survivors among the pairs of each class with its bucket's leader of this turn."""
        leaders = parked(
            mixed.groupBy("key").agg(
                F.min_by(
                    F.struct("cid", "comp"), F.xxhash64("key", "cid", F.lit(turn))
                ).alias("leader")
            ),
            "leaders",
        ).select("key", F.col("leader.cid").alias("lead"), F.col("leader.comp").alias("lead_comp"))
        pairs = (
            mixed.join(leaders, "key")
            .where("comp <> lead_comp")
            .select(F.least("cid", "lead").alias("a"), F.greatest("cid", "lead").alias("b"))
            .distinct()
        )
        return self.pruned(self.untested(pairs))

    def untested(self, pairs: DataFrame) -> DataFrame:
        return pairs if self.tested is None else pairs.join(self.tested, ["a", "b"], "left_anti")

    def pruned(self, pairs: DataFrame) -> DataFrame:
        pairs = parked(pairs, "pairs")
        sigs = self.sigs
        return pairs.join(sigs.select(F.col("cid").alias("a"), F.col("sig").alias("sig_a")), "a").join(
            sigs.select(F.col("cid").alias("b"), F.col("sig").alias("sig_b")), "b"
        ).select("a", "b", "sig_a", "sig_b").mapInArrow(
            functools.partial(_prune, self.percent), "a bigint, b bigint, matches bigint"
        )

    def remainder(self, mixed: DataFrame) -> DataFrame:
        """Links of all classes outside a bucket's main component with the others in it."""
        sizes = mixed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
        main = parked(
            sizes.groupBy("key").agg(
                F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("total")
            ),
            "mains",
        ).select("key", F.col("main.comp").alias("main"), F.col("main.n").alias("most"), "total")
        place = F.xxhash64("cid", F.lit(3))
        chunks = F.ceil(F.col("total") / CHUNK_ALL).cast("int")
        fews = F.ceil((F.col("total") - F.col("most")) / CHUNK_FEW).cast("int")
        rows = (
            mixed.join(main, "key")
            .withColumn("lesser", F.col("comp") != F.col("main"))
            .withColumn("chunks", chunks)
            .withColumn("fews", fews)
            .withColumn("chunk", F.pmod(place, F.col("chunks")).cast("int"))
            .withColumn("few", F.pmod(place, F.col("fews")).cast("int"))
        )
        rows = parked(rows, "members")
        # A chunk of lesser classes meets a chunk of all: a class goes to the groups
        # that it has a part in, each with a bounded number of classes.
        as_one_of_all = F.transform(
            F.sequence(F.lit(0), F.col("fews") - 1),
            lambda i: F.struct(i.alias("fc"), F.col("chunk").alias("ac")),
        )
        as_lesser = F.transform(
            F.sequence(F.lit(0), F.col("chunks") - 1),
            lambda i: F.struct(F.col("few").alias("fc"), i.alias("ac")),
        )
        groups = F.when(
            F.col("lesser"), F.array_distinct(F.concat(as_one_of_all, as_lesser))
        ).otherwise(as_one_of_all)
        members = (
            rows.join(self.sigs, "cid")
            .join(self.texts, "cid")
            .withColumn("group", F.explode(groups))
            .select(
                "key", "group.fc", "group.ac", "band", "cid", "comp", "lesser", "chunk", "few",
                "sig", "text",
            )
        )
        percent = self.percent  # a grouped function's arguments are counted
        return members.groupBy("key", "fc", "ac").applyInArrow(
            lambda key, table: _bucket_links(percent, key, table), "a bigint, b bigint"
        )

    def verify(self, pairs: DataFrame) -> DataFrame:
        texts = self.texts
        return (
            pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("left")), "a")
            .join(texts.select(F.col("cid").alias("b"), F.col("text").alias("right")), "b")
            .select("a", "b", "left", "right")
            .mapInArrow(functools.partial(_verify, self.percent), "a bigint, b bigint")
        )

    def across(self, pool: DataFrame) -> DataFrame:
        """Pairs of the pool whose classes are in different components so far."""
        c = self.comps
        return (
            pool.join(c.select(F.col("cid").alias("a"), F.col("comp").alias("comp_a")), "a")
            .join(c.select(F.col("cid").alias("b"), F.col("comp").alias("comp_b")), "b")
            .where("comp_a <> comp_b")
        )

    def join_by(self, links: DataFrame) -> None:
        """Join the components that links connect."""
        joined = self.across(parked(links, "links")).select("comp_a", "comp_b").distinct()
        new = components(joined, "comp_a", "comp_b")
        self.comps = parked(
            self.comps.join(new, F.col("comp") == F.col("node"), "left").select(
                "cid", F.coalesce("component", "comp").alias("comp")
            ),
            "comps",
        )

    def settle(self, pool: DataFrame) -> None:
        """Verify the pairs that look best to each component, in turns; join what they link.

        What is not verified here and still lies between components is left to the
        remainder.
        """
        pool = parked(pool, "pool")
        for best in STAR_BEST:
            across = parked(self.across(self.untested(pool)), "across")
            if across.isEmpty():
                return
            sides = F.explode(F.array("comp_a", "comp_b")).alias("side")
            rank = F.row_number().over(
                Window.partitionBy("side").orderBy(F.col("matches").desc(), "a", "b")
            )
            chosen = parked(
                across.select("a", "b", "matches", sides)
                .withColumn("rank", rank)
                .where(F.col("rank") <= best)
                .select("a", "b")
                .distinct(),
                "chosen",
            )
            self.tested = chosen if self.tested is None else self.tested.unionByName(chosen)
            self.join_by(self.verify(chosen))

    def run(self) -> DataFrame:
        for turn in range(STAR_ROUNDS):
            mixed = self.mixed()
            if mixed.isEmpty():
                return self.comps
            self.settle(self.star(mixed, turn))
        mixed = self.mixed()
        if not mixed.isEmpty():
            self.join_by(self.remainder(mixed))
        return self.comps


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``.

    A document's set has its distinct shingles of five words, or all its words as one if
    there are fewer. Documents are linked at a Jaccard similarity of ``percent`` and more; the
    component is the smallest id that links reach. A null or empty text has no shingles
    and is linked with nothing. Rows that repeat an id with the same text are one
    document; a null id is a component's only if it has no other. An empty table gives an
    empty result.
    """
    return _groups(docs, id_col, text_col, percent).drop("_hash")


def _groups(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("_text"),
        F.xxhash64(text_col).alias("_hash"),
    )
    id_type = rows.schema["_id"].dataType.simpleString()
    sketches = parked(
        rows.mapInArrow(
            _sketch, f"_id {id_type}, n_shingles bigint, set_key binary, sig binary, _hash bigint"
        ),
        "sketches",
    )
    classes = parked(
        sketches.where("set_key is not null")
        .groupBy("set_key")
        .agg(F.min("_id").alias("first_id"), F.min("sig").alias("sig"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    comps = _Search(classes, docs, text_col, percent).run()
    grouped = classes.select("cid", "set_key", "first_id").join(comps, "cid", "left")
    grouped = parked(
        grouped.select("set_key", "first_id", F.coalesce("comp", "cid").alias("comp")), "grouped"
    )
    names = parked(grouped.groupBy("comp").agg(F.min("first_id").alias("component_id")), "names")
    labels = parked(grouped.join(names, "comp").select("set_key", "component_id"), "labels")
    component = F.when(F.col("set_key").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return sketches.join(labels, "set_key", "left").select(
        F.col("_id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
        "_hash",
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` that stay: of each component those with the smallest id.

    Rows are named by id and hash of the text, so that of rows that share an id but not
    the text each is judged by its own. Rows without an id stay.
    """
    gone = _groups(docs, id_col, text_col, percent).where("not kept").select(
        F.col(id_col).alias("_gone"), "_hash"
    )
    gone = parked(gone.distinct(), "gone")
    match = (F.col(id_col) == F.col("_gone")) & (F.xxhash64(text_col) == F.col("_hash"))
    return docs.join(gone, match, "left_anti")
