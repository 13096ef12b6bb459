"""A trie of conversation prefixes from sorted matrices of turn ids.

A turn is 24 bytes: 16 of a SHA-256 of role and text, and the length of the text. A
conversation is its turns put together, so that the order of these bytes is the order of
the trie. The conversations are range-partitioned by them (and by id, so that thousands of
equal ones spread) and sorted. A task takes blocks of bounded size: their turn ids are a
padded matrix, sorted by ``lexsort``; the columns' changes from row to row, accumulated by
OR from the left, mark where nodes start, and ``reduceat`` adds up every depth.

All that is kept of a node is a sum over its rows: members, node starts one deeper
(children), rows that no later row continues (leaves), and bytes of the turns of its rows
less those of the nodes that start there (saved). So a node cut by a block border is the
sum of its parts. Only the nodes on the paths of a block's first and last row can be cut.
These few are put together by the hash of their prefix; what a block could not know of its
neighbours, that its first row continues a path or that its last row is continued, is put
right there from the length of the common prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import parked

TURN = 24  # bytes of a turn: digest, and length of the text
BLOCK_CELLS = 1 << 20  # rows times longest row of a matrix; a longer row is one by itself
BLOCK_ROWS = 100_000

# Fixed values of the rebuilding: conversations that share a start, and lengths of starts.
SHARED = 5
STARTS = 9

COLUMNS = {
    "block": pa.int64(),  # the order of the blocks is that of their rows
    "node": pa.int64(),  # number within the block
    "depth": pa.int64(),
    "conv_id": pa.int64(),
    "parent_conv_id": pa.int64(),
    "parent_node": pa.int64(),  # where the parent may be cut by the block's border
    "n_convs": pa.int64(),
    "n_children": pa.int64(),
    "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(),
    "ends_sha256": pa.string(),
    # Of nodes on the path of the block's first or last row:
    "key": pa.binary(),
    "parent_key": pa.binary(),
    "on_first": pa.bool_(),
    "on_last": pa.bool_(),
    "text_bytes": pa.int64(),
    "path_bytes": pa.int64(),
    "last_depth": pa.int64(),
    "ends": pa.binary(),
}
SPARK_TYPES = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}
SCHEMA = ", ".join(f"{c} {SPARK_TYPES.get(t, 'boolean')}" for c, t in COLUMNS.items())


def conversation_turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """``conv_id`` and its ``turns`` in order, each as 48 hexadecimal digits.

    Ordered by turn, a null one first, then by role and digest. Null roles and texts are
    empty. Rows without a conversation belong to none. A conversation's turns lie in one
    row, without their texts.
    """
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.octet_length(text)), 16, "0"))
    return (
        conversations.where(F.col(f"`{id_col}`").isNotNull())
        .select(
            F.col(f"`{id_col}`").cast("long").alias("conv_id"),
            F.struct(
                F.col(f"`{turn_col}`").alias("at"), role.alias("role"), F.lower(turn).alias("id")
            ).alias("turn"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select("conv_id", F.expr("transform(turns, t -> t.id)").alias("turns"))
    )


def rebuilt(turns: DataFrame, shared: int = SHARED, starts: int = STARTS) -> DataFrame:
    """Every conversation with the first turns of another in place of its own.

    With ``h`` the CRC-32 of the id modulo ``starts``, the first ``h`` turns are those of the
    conversation whose id is the next lower multiple of ``shared`` (none if it is absent,
    a negative id's is the next higher), followed by the own turns after the first ``h``.
    """
    kept = parked(turns, "turns")
    base = kept.select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, starts).alias("_first")
    )
    return (
        kept.withColumn("_of", F.col("conv_id") - F.col("conv_id") % shared)
        .withColumn("_h", (F.crc32(F.col("conv_id").cast("string")) % starts).cast("int"))
        .join(base, F.col("_of") == F.col("_base"), "left")
        .select(
            "conv_id",
            F.expr(
                "concat(slice(coalesce(_first, array()), 1, _h), "
                "slice(turns, _h + 1, greatest(size(turns) - _h, 0)))"
            ).alias("turns"),
        )
    )


def _chain(path: bytes) -> list[bytes]:
    """The keys of a path's prefixes from the root on, each made from the one before."""
    keys = [hashlib.sha256(b"").digest()[:16]]
    for at in range(0, len(path), TURN):
        keys.append(hashlib.sha256(keys[-1] + path[at : at + TURN]).digest()[:16])
    return keys


def block_nodes(number: int, conv: np.ndarray, paths: list[bytes]) -> pa.RecordBatch:
    """The nodes of a block of conversations, as far as the block knows them."""
    n, length = len(paths), np.array([len(p) // TURN for p in paths], np.int64)
    deepest = int(length.max())
    flat = np.frombuffer(b"".join(paths), np.uint8).reshape(-1, TURN)
    names, codes = np.unique(flat.copy().view(f"S{TURN}").ravel(), return_inverse=True)
    cells = np.arange(deepest) < length[:, None]
    ids, size = np.zeros((n, deepest), np.int32), np.zeros((n, deepest), np.int64)
    ids[cells] = codes.ravel() + 1
    size[cells] = flat[:, 16:].copy().view(">u8").ravel().astype(np.int64)
    order = np.lexsort((conv, *ids.T[::-1]))
    conv, length, ids, size = conv[order], length[order], ids[order], size[order]

    changed = np.ones((n, deepest), bool)
    changed[1:] = ids[1:] != ids[:-1]
    changed = np.logical_or.accumulate(changed, axis=1)
    start = changed & (ids > 0)
    # Rows that the next one does not continue; of the last row that is not known yet.
    leaf = np.append((~changed[1:]).sum(1) < length[:-1], True).astype(np.int64)
    held = np.cumsum(size[:, ::-1], axis=1)[:, ::-1] if deepest else np.zeros((n, 1), np.int64)
    own = np.where(start, size, 0)
    kept = np.cumsum(own[:, ::-1], axis=1)[:, ::-1] if deepest else np.zeros((n, 1), np.int64)
    saved = held - kept

    out = {c: [] for c in ("depth", "first", "last", "parent", "conv_id", "n_convs", "n_children",
                           "n_leaves", "saved_tokens", "n_ends", "text_bytes")}
    node_of, total = np.zeros(n, np.int64), 0
    for depth in range(deepest + 1):
        rows = np.flatnonzero(length >= depth)
        at = np.flatnonzero(start[rows, depth - 1]) if depth else np.zeros(1, np.int64)
        count = np.diff(np.append(at, len(rows)))
        first = rows[at]
        out["depth"].append(np.full(len(at), depth))
        out["first"].append(first)
        out["last"].append(rows[at + count - 1])
        out["parent"].append(node_of[first] if depth else np.full(1, -1))
        out["conv_id"].append(np.minimum.reduceat(conv[rows], at))
        out["n_convs"].append(count)
        deeper = start[rows, depth].astype(np.int64) if depth < deepest else np.zeros(len(rows), int)
        out["n_children"].append(np.add.reduceat(deeper, at))
        out["n_leaves"].append(np.add.reduceat(leaf[rows], at))
        out["saved_tokens"].append(np.add.reduceat(saved[rows, max(depth - 1, 0)], at))
        out["n_ends"].append(np.add.reduceat((length[rows] == depth).astype(np.int64), at))
        out["text_bytes"].append(size[first, depth - 1] if depth else np.zeros(1, np.int64))
        node_of[rows] = total + np.repeat(np.arange(len(at)), count)
        total += len(at)
    nodes = {c: np.concatenate(v) for c, v in out.items()}

    on_first, on_last = nodes["first"] == 0, nodes["last"] == n - 1
    border = on_first | on_last
    keys = {row: _chain(paths[order[row]]) for row in (0, n - 1)}
    inside = np.where(nodes["parent"] >= 0, border[nodes["parent"]], False)
    rest: dict[str, list] = {c: [] for c in list(COLUMNS)[10:]}
    path_bytes = {row: np.append(0, np.cumsum(size[row])) for row in (0, n - 1)}
    nothing = hashlib.sha256(b"").hexdigest()
    for i in range(total):
        # The rows that end at a node are its first ones.
        begin, ends = nodes["first"][i], nodes["n_ends"][i]
        listed = ",".join(map(str, conv[begin : begin + ends].tolist())).encode() if ends else b""
        depth = nodes["depth"][i]
        row = 0 if on_first[i] else n - 1
        rest["ends_sha256"].append(
            None if border[i] else hashlib.sha256(listed).hexdigest() if ends else nothing
        )
        rest["key"].append(keys[row][depth] if border[i] else None)
        rest["parent_key"].append(keys[row][depth - 1] if border[i] and depth else None)
        rest["on_first"].append(bool(on_first[i]))
        rest["on_last"].append(bool(on_last[i]))
        rest["text_bytes"].append(nodes["text_bytes"][i])
        rest["path_bytes"].append(path_bytes[row][depth] if border[i] else None)
        rest["last_depth"].append(int(length[-1]) if border[i] else None)
        rest["ends"].append(listed if border[i] else None)
    parent_conv = nodes["conv_id"][np.maximum(nodes["parent"], 0)]
    known = {
        "block": np.full(total, number),
        "node": np.arange(total),
        "parent_conv_id": pa.array(parent_conv, mask=inside | (nodes["parent"] < 0)),
        "parent_node": pa.array(nodes["parent"], mask=~inside),
        **{c: nodes[c] for c in ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")},
        **rest,
    }
    return pa.RecordBatch.from_arrays(
        [pa.array(known[c], t) if not isinstance(known[c], pa.Array) else known[c] for c, t in COLUMNS.items()],
        list(COLUMNS),
    )


def _blocks(most_cells: int, most_rows: int):
    """Sorted conversations of a partition in blocks, and the nodes of each."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, conv, paths, longest = TaskContext.get().partitionId(), 0, [], [], 0

        def done() -> pa.RecordBatch:
            return block_nodes(task << 32 | number, np.array(conv, np.int64), paths)

        for batch in batches:
            for key, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                deeper = max(longest, len(path) // TURN)
                if paths and ((len(paths) + 1) * deeper > most_cells or len(paths) == most_rows):
                    yield done()
                    number, conv, paths, deeper = number + 1, [], [], len(path) // TURN
                longest = deeper
                conv.append(key)
                paths.append(path)
        if paths:
            yield done()

    return blocks


def _put_right(border: DataFrame) -> DataFrame:
    """The parts of cut nodes, knowing what the neighbouring blocks share."""
    before = Window.orderBy("block")  # one row per block
    chained = border.groupBy("block").agg(F.max("last_depth").alias("_ends_at")).select(
        "block", F.lag("block").over(before).alias("_prev"), "_ends_at"
    )
    shared = (
        border.where("on_first")
        .join(chained.select("block", "_prev"), "block")
        .select("block", "_prev", "key", "depth", "path_bytes")
        .join(
            border.where("on_last").select(
                F.col("block").alias("_prev"), "key", F.col("last_depth").alias("_reached")
            ),
            ["_prev", "key"],
        )
        .groupBy("block", "_prev", "_reached")
        .agg(F.max("depth").alias("_common"), F.max("path_bytes").alias("_common_bytes"))
    )
    shared = parked(shared, "shared")
    continued = shared.where(F.col("_common") >= F.col("_reached")).select(
        F.col("_prev").alias("block"), F.lit(1).alias("_continued")
    )
    held = F.col("on_first") & (F.col("depth") <= F.col("_common"))
    return (
        border.join(shared.select("block", "_common", "_common_bytes"), "block", "left")
        .join(continued, "block", "left")
        .withColumn(
            "saved_tokens",
            F.col("saved_tokens")
            + F.when(
                held, F.col("_common_bytes") - F.col("path_bytes") + F.col("text_bytes")
            ).otherwise(0),
        )
        .withColumn(
            "n_children",
            F.col("n_children")
            - F.when(held & (F.col("depth") < F.col("_common")), 1).otherwise(0),
        )
        .withColumn(
            "n_leaves",
            F.col("n_leaves")
            - F.when(F.col("on_last") & F.col("_continued").isNotNull(), 1).otherwise(0),
        )
    )


def _end_digests(border: DataFrame) -> DataFrame:
    """The digest of the ids that end at each cut node.

    The parts, each the ids of one block, come in order of blocks and so of ids; the
    digest takes them one after the other, none is kept.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def row() -> pa.RecordBatch:
            columns = [pa.array([current], pa.binary()), pa.array([state.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, ["key", "ends_sha256"])

        for batch in batches:
            for key, ends in zip(batch.column(0), batch.column(1)):
                if key.as_py() != current:
                    if current is not None:
                        yield row()
                    current, state = key.as_py(), hashlib.sha256(ends.as_py())
                else:
                    state.update(b"," + ends.as_py())
        if current is not None:
            yield row()

    return (
        border.where(F.length("ends") > 0)
        .select("key", "ends", "block")
        .repartition("key")
        .sortWithinPartitions("key", "block")
        .mapInArrow(digest, "key binary, ends_sha256 string")
    )


def prefix_trie(
    turns: DataFrame, block_cells: int = BLOCK_CELLS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The nodes of all prefixes of ``turns`` (``conv_id`` and turns as hexadecimal digits).

    Per node: ``conv_id``, its smallest member; ``depth``; the parent's ``conv_id`` (null at
    the root); members, children and childless nodes below (itself included); the bytes
    that its subtree's last texts would save if each were kept once; the digest of the ids
    that end there. A conversation without turns ends at the root. Ids are distinct. An
    empty table has no node, not even a root. The digest of an end is taken in one task,
    as ids one after the other; nothing else of a node lies in one.
    """
    paths = parked(
        turns.select("conv_id", F.unhex(F.array_join("turns", "")).alias("path")), "paths"
    )
    partial = parked(
        paths.repartitionByRange("path", "conv_id")
        .sortWithinPartitions("path", "conv_id")
        .mapInArrow(_blocks(block_cells, block_rows), SCHEMA),
        "nodes",
    )
    border = partial.where("key is not null")
    merged = parked(
        _put_right(border)
        .groupBy("key")
        .agg(
            F.max("depth").alias("depth"),
            F.max("parent_key").alias("parent_key"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        )
        .join(_end_digests(border), "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256))),
        "merged",
    )
    known = merged.select(F.col("key").alias("_key"), F.col("conv_id").alias("_conv"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
             "saved_tokens", "ends_sha256"]
    whole = partial.where("key is null")
    cut_parents = border.join(known, F.col("key") == F.col("_key")).select(
        F.col("block").alias("_block"), F.col("node").alias("_node"), "_conv"
    )
    below = (
        whole.where("parent_node is not null")
        .join(
            cut_parents,
            (F.col("block") == F.col("_block")) & (F.col("parent_node") == F.col("_node")),
        )
        .withColumn("parent_conv_id", F.col("_conv"))
    )
    cut = merged.join(known, F.col("parent_key") == F.col("_key"), "left").withColumn(
        "parent_conv_id", F.col("_conv")
    )
    return (
        whole.where("parent_node is null")
        .select(*names)
        .unionByName(below.select(*names))
        .unionByName(cut.select(*names))
    )
