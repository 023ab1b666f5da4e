"""Prefix trie of conversations, from vertical bitmaps per shard of conversation ids.

A shard is a range of ids, aligned to the blocks whose conversations share opening turns. In a shard, the conversations with
a given turn at a given position are a bitset. The children of a node are found depth first: the lowest id left in
the node's bitset names a turn, the intersection with that turn's bitset is the child, and its bits are taken out. Bits set give
members, bits whose conversation ends there give the end list. Positions are read WINDOW at a time, and what is left
of a path at a window's end goes on with the next, so memory follows the ids of a shard and not the turns of the longest conversation.

Nodes of all shards meet under a 128-bit hash of their turns. A node's shards are pre-aggregated: one row a shard.
Sums over subtrees are taken per shard, bottom up, and added: members times words in every shard, the words and the
leaf itself only in the first shard that knows the node. End lists are hashed in the order of shards, as one stream.

Turns are ordered by (turn, nulls first), equal turns by a hash of role and text. Null roles and texts are empty. Rows without a
conversation id belong to none. A repeated row is a turn of its own. An empty table has no node, not even a root.
Texts are hashed where they are read and travel no further, so a long one costs nothing more. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import dropped, written

BLOCK = 20  # conversations c and c - c % BLOCK share opening turns
SHARED = 4  # the first crc32(c) % SHARED of them
SHARD = 100 * BLOCK  # ids of a shard
WINDOW = 64

NODES = "shard long, node binary, parent binary, depth long, words long, n long, first long, ends binary"
ROOT = bytes(16)


def opening(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the first of its block."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % SHARED).cast("int")


def base(conv_id: Column) -> Column:
    return conv_id - conv_id % BLOCK


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(shard, position, conv_id, code, words): the turns of rebuilt conversations from position 1, and one row each at 0.

    A code is a hash of role and text, the lengths of which keep them apart.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    words = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("code"),
        words.alias("words"),
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "code"))
    turns = written(turns.select("conv_id", place.alias("place"), "code", "words"))
    conv = F.col("conv_id")
    heads = turns.where((conv % BLOCK == 0) & (F.col("place") < SHARED))
    heads = heads.groupBy(conv.alias("base")).agg(F.array_sort(F.collect_list(F.struct("place", "code", "words"))).alias("head"))
    head = F.coalesce("head", F.array().cast(heads.schema["head"].dataType))
    taken = F.slice(head, 1, opening(conv))
    each = turns.where("place = 1").select("conv_id", base(conv).alias("base"))
    each = each.join(heads, "base", "left").select("conv_id", taken.alias("taken"))
    own = turns.where(F.col("place") > opening(conv)).withColumn("base", base(conv))
    sizes = heads.select("base", F.size("head").alias("held"))
    own = own.join(sizes, "base", "left")
    known = F.least(F.coalesce("held", F.lit(0)), opening(conv))
    own = own.select((F.col("place") - opening(conv) + known).alias("position"), "conv_id", "code", "words")
    starts = each.select(F.lit(0).alias("position"), "conv_id", F.lit(None).cast("binary").alias("code"), F.lit(0).cast("long").alias("words"))
    shared = each.select("conv_id", F.posexplode("taken").alias("at", "x"))
    shared = shared.select((F.col("at") + 1).alias("position"), "conv_id", "x.code", "x.words")
    shard = F.floor(base(F.col("conv_id")) / SHARD)
    return starts.unionByName(shared).unionByName(own).withColumn("shard", shard).select("shard", "position", "conv_id", "code", "words")


def _groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(value of column 0, rows): runs of rows with equal columns 0 and `by`, of sorted batches; a run may come in parts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in (0, by)]
        change = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
        edges = np.r_[0, np.flatnonzero(change) + 1, batch.num_rows]
        for low, high in zip(edges[:-1], edges[1:]):
            yield int(keys[0][low]), batch.slice(low, high - low)


class ShardTrie:
    """The nodes of one shard, built from its turns in the order of positions."""

    def __init__(self, shard: int):
        self.shard = shard
        self.ids: list[int] = []
        self.bit: dict[int, int] = {}
        self.open: list[tuple[bytes, int, int]] = []  # (node, depth, members) that may go on
        self.out: list[tuple] = []
        self.clear()

    def clear(self) -> None:
        self.posting: dict[tuple[int, bytes], int] = {}  # members with a turn at a position
        self.turn: dict[tuple[int, int], bytes] = {}  # turn at a position of a member
        self.words: dict[bytes, int] = {}
        self.top = 0

    def start(self, ids: list[int]) -> None:
        """Conversations of the shard, ascending; may come in several parts."""
        for c in ids:
            self.bit[c] = len(self.ids)
            self.ids.append(c)
        everyone = (1 << len(self.ids)) - 1
        self.open, self.out = [(ROOT, 0, everyone)], []
        self.emit(ROOT, None, 0, 0, everyone)

    def read(self, position: int, ids: list[int], codes: list[bytes], words: list[int]) -> None:
        self.top = position
        for c, code, n in zip(ids, codes, words):
            bit = self.bit[c]
            self.posting[position, code] = self.posting.get((position, code), 0) | 1 << bit
            self.turn[position, bit] = code
            self.words[code] = n

    def descend(self, last: bool) -> None:
        """Follow all open nodes through the positions read; at the end of the window they stay open."""
        stack, self.open = self.open, []
        while stack:
            node, depth, members = stack.pop()
            if depth == self.top and not last:
                self.open.append((node, depth, members))
                continue
            left = members
            ended = 0
            while left:
                low = left & -left
                code = self.turn.get((depth + 1, low.bit_length() - 1))
                if code is None:
                    ended |= low
                    left ^= low
                    continue
                child = members & self.posting[depth + 1, code]
                left &= ~child
                name = hashlib.blake2b(node + code, digest_size=16).digest()
                self.emit(name, node, depth + 1, self.words[code], child)
                stack.append((name, depth + 1, child))
            if ended:
                self.out.append((self.shard, node, None, depth, 0, 0, None, self.packed(ended)))
        self.clear()

    def packed(self, members: int) -> bytes:
        bits = np.unpackbits(np.frombuffer(members.to_bytes((len(self.ids) + 7) // 8, "little"), np.uint8), bitorder="little")
        return np.array(self.ids, np.int64)[np.flatnonzero(bits)].tobytes()

    def emit(self, node: bytes, parent: bytes | None, depth: int, words: int, members: int) -> None:
        first = self.ids[(members & -members).bit_length() - 1]
        self.out.append((self.shard, node, parent, depth, words, members.bit_count(), first, None))

    def taken(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        types = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["shard", "node", "parent", "depth", "words", "n", "first", "ends"]
        columns = list(zip(*rows)) if rows else [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """NODES: a row for every node of a shard, and rows that carry only the ids that end there; turns come by shard and position."""
    trie: ShardTrie | None = None
    last = 0
    for shard, rows in _groups(batches, 1):
        position = rows.column(1)[0].as_py()
        if trie is None or trie.shard != shard:
            if trie is not None:
                trie.descend(True)
                yield trie.taken()
            trie, last = ShardTrie(shard), 0
        ids = rows.column(2).to_pylist()
        if position == 0:
            trie.start(ids)
            continue
        if position != last and last and last % WINDOW == 0:
            trie.descend(False)
            yield trie.taken()
        trie.read(position, ids, rows.column(3).to_pylist(), rows.column(4).to_pylist())
        last = position
    if trie is not None:
        trie.descend(True)
        yield trie.taken()


def shard_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, saved, leaves): sums over the subtrees of a shard's nodes, which come deepest first."""
    at, above, here = None, {}, {}
    for shard, rows in _groups(batches, 1):
        depth = rows.column(1)[0].as_py()
        if at != (shard, depth):
            # Sums of this level were gathered from the level below, if that was read just before.
            here = above if at == (shard, depth + 1) else {}
            at, above = (shard, depth), {}
        found = []
        columns = [rows.column(c).to_pylist() for c in range(2, 6)]
        for node, parent, saved, leaves in zip(*columns):
            below = here.get(node, (0, 0))
            saved, leaves = saved + below[0], leaves + below[1]
            found.append((node, saved, leaves))
            if parent is not None:
                a, b = above.get(parent, (0, 0))
                above[parent] = (a + saved, b + leaves)
        node, saved, leaves = zip(*found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node, pa.binary()), pa.array(saved, pa.int64()), pa.array(leaves, pa.int64())], ["node", "saved", "leaves"]
        )


def hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends_sha256) of end lists that come by node and shard."""
    node, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])

    for batch in batches:
        for name, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            text = ",".join(map(str, np.frombuffer(ends, np.int64).tolist()))
            if name != node:
                if digest is not None:
                    yield row()
                node, digest = name, hashlib.sha256()
            else:
                text = "," + text
            digest.update(text.encode())
    if digest is not None:
        yield row()


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    turns = rebuilt(conversations).repartition("shard").sortWithinPartitions("shard", "position", "conv_id")
    partial = written(turns.mapInArrow(shard_nodes, NODES))
    nodes = partial.where("n > 0")
    merged = nodes.groupBy("node").agg(
        F.first("parent", True).alias("parent"),
        F.max("depth").alias("depth"),
        F.sum("n").alias("n_convs"),
        F.min("first").alias("conv_id"),
        F.min("shard").alias("owner"),
    )
    merged = written(merged)
    children = merged.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    info = written(merged.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    dropped(merged)

    owned = F.col("shard") == F.col("owner")
    counted = nodes.join(info.select("node", "owner", "n_children"), "node").select(
        "shard",
        "depth",
        "node",
        "parent",
        (F.col("n") * F.col("words") - F.when(owned, F.col("words")).otherwise(0)).alias("saved"),
        (owned & (F.col("n_children") == 0)).cast("long").alias("leaves"),
    )
    counted = counted.repartition("shard").sortWithinPartitions("shard", F.col("depth").desc())
    sums = counted.mapInArrow(shard_sums, "node binary, saved long, leaves long")
    sums = sums.groupBy("node").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    ends = partial.where("ends IS NOT NULL").select("node", "shard", "ends").repartition("node")
    ends = ends.sortWithinPartitions("node", "shard").mapInArrow(hashed_ends, "node binary, ends_sha256 string")
    above = info.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = info.join(sums, "node").join(ends, "node", "left").join(above, "parent", "left")
    none = hashlib.sha256().hexdigest()
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
