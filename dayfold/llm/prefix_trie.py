"""Trie of conversation prefixes by range minima over sorted common-prefix lengths.

Every distinct sequence of first turns of some conversation is a node. Conversations are sorted by
the digests of their turns, so those below a node are neighbours: node and depth are an interval in
which all lengths of common prefixes of neighbours are at least the depth. A sparse table holds
minima of these lengths over stretches of powers of two; each candidate prefix finds its left and
its right end by a binary search of its own over the table. No stack and no order of work among
candidates is needed, and all of a block are searched at once.

Conversations are range-partitioned by path and id, so that a group of equal ones is split as well,
and a partition is worked off in blocks of bounded size. A node within one block is finished there.
Nodes that touch the edge of a block are only prefixes of its first and its last conversation; each
block gives its part of them, and parts of one node are added up. What neighbouring blocks both
count is taken off by a correction per border, from the common prefix of the conversations there.

A null role or text is empty. Turns are in order of their number, a null one first; turns with one
number are in order of their digest. Repeated rows are turns of their own. Rows without ``conv_id``
belong to no conversation and take no part. Other columns are not looked at. An empty table has no
nodes, not even a root. A conversation without turns is a member of the root alone. Texts may be of
any length: only a digest of 128 bits and a number of words per turn leave the first step; a
conversation is a row of 24 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import small_side, written
from .mixing import sizes

# A block ends with so many conversations or turns.
BLOCK, BLOCK_TURNS = 1 << 16, 1 << 20

# Conversations for which a partition is made.
PER_PARTITION = 1 << 17

# Turns that a conversation may share by the rule of rebuilding, and the ids that share them.
SHARED, FAMILY = 4, 20

DIGEST = 16
NODE, PART, END, EDGE = range(4)
PIECES = (
    "kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved long, ends string, key binary, parent binary, task int, path binary, words array<long>"
)
_KIND = pa.schema([
    ("kind", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()),
    ("ends", pa.string()), ("key", pa.binary()), ("parent", pa.binary()), ("task", pa.int32()),
    ("path", pa.binary()), ("words", pa.list_(pa.int64())),
])


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` (order, digest, words) of every conversation, in order of turns."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", digest.alias("digest"), sizes("text").alias("words")).alias("turn"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(convs: DataFrame, shared: int = SHARED, family: int = FAMILY) -> DataFrame:
    """Conversations of which the first turns come from the first one of their family.

    How many do, from none to ``shared`` - 1, is told by a checksum of the id.
    """
    first = convs.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, shared - 1).alias("head"))
    rows = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    none = F.slice("turns", 1, 0)
    return rows.join(first, "base", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("head", none), F.lit(1), h), F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def paths(convs: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` (the digests of its turns in a row) and ``words`` of each turn."""
    return convs.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"))


class RangeMinima:
    """Minima over stretches of a row of numbers, and how far from a place they stay at a limit."""

    def __init__(self, row: np.ndarray):
        self.levels = [row]
        while len(self.levels[-1]) > (step := 1 << (len(self.levels) - 1)):
            self.levels.append(np.minimum(self.levels[-1][:-step], self.levels[-1][step:]))

    def over(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minima from ``low`` to ``high``, both included."""
        level = np.log2(high - low + 1).astype(np.int64)
        out = np.empty(len(low), dtype=self.levels[0].dtype)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.levels[k][low[own]], self.levels[k][high[own] - (1 << int(k)) + 1])
        return out

    def right(self, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The largest r for which the numbers after ``at`` and up to r are all at least ``limit``."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            row = self.levels[k]
            inside = at + 1 < len(row)
            further = inside & (row[np.where(inside, at + 1, 0)] >= limit)
            at[further] += 1 << k
        return at

    def left(self, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The smallest l for which the numbers after l and up to ``at`` are all at least ``limit``."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            row, start = self.levels[k], at - (1 << k) + 1
            inside = start > 0
            further = inside & (row[np.where(inside, start, 0)] >= limit)
            at[further] -= 1 << k
        return at


def _keys(path: bytes, depth: int) -> list[bytes]:
    """Names of the prefixes of a path up to a depth, each made from the one before it."""
    keys = [hashlib.blake2b(digest_size=DIGEST).digest()]
    for d in range(depth):
        keys.append(hashlib.blake2b(keys[-1] + path[DIGEST * d : DIGEST * (d + 1)], digest_size=DIGEST).digest())
    return keys


def _common(one: bytes, two: bytes) -> int:
    """Turns that two paths have in common."""
    n = min(len(one), len(two)) // DIGEST
    pair = [np.frombuffer(p, dtype=f"V{DIGEST}", count=n) for p in (one, two)]
    differ = np.flatnonzero(pair[0] != pair[1])
    return int(differ[0]) if len(differ) else n


def _batch(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _KIND], schema=_KIND)


def border(one: bytes, words: np.ndarray, two: bytes) -> pa.RecordBatch:
    """What two blocks count twice of the nodes they share: ``one`` ends a block, ``two`` begins the next."""
    shared, length = _common(one, two), len(one) // DIGEST
    keys, n = _keys(one, shared), shared + 1
    before = np.concatenate(([0], np.cumsum(words[:shared], dtype=np.int64)))
    depth = np.arange(n)
    return _batch(
        n, kind=[PART] * n, depth=depth, n_convs=[0] * n, n_children=-(depth < shared).astype(np.int64),
        n_leaves=[-int(length == shared)] * n, saved=before[-1] - before[np.maximum(depth - 1, 0)],
        key=keys, parent=[None, *keys[:-1]])


class Block:
    """Conversations that follow one another in sorted order."""

    def __init__(self, ids: np.ndarray, path: list[bytes], words: np.ndarray, first: np.ndarray):
        """Turns of conversation i are ``first[i]`` to ``first[i + 1]`` of ``words``."""
        self.ids, self.path, self.words, self.first = ids, path, words, first

    def common(self) -> np.ndarray:
        """Lengths of common prefixes with the conversation before; -1 for the first."""
        out = np.full(len(self.ids), -1, dtype=np.int64)
        turns = np.frombuffer(b"".join(self.path), dtype=np.int64).reshape(-1, 2)
        length = np.diff(self.first)
        most = np.minimum(length[:-1], length[1:])
        out[1:] = most
        pair = np.repeat(np.arange(len(most)), most)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(most) - most, most)
        differ = (turns[self.first[pair] + place] != turns[self.first[pair + 1] + place]).any(axis=1)
        np.minimum.at(out, pair[differ] + 1, place[differ])
        return out

    def nodes(self) -> Iterator[pa.RecordBatch]:
        n, length, common = len(self.ids), np.diff(self.first), self.common()
        minima = RangeMinima(common)
        # Candidates: the prefixes of each conversation that the one before it does not have.
        fresh = length - common
        begin = np.concatenate(([0], np.cumsum(fresh)))
        conv = np.repeat(np.arange(n), fresh)
        depth = np.arange(begin[-1]) - begin[conv] + common[conv] + 1
        left, right = minima.left(conv, depth), minima.right(conv, depth)
        size = right - left + 1
        # The prefix one turn shorter begins where its own search to the left ends.
        inner = depth > 0
        above = np.where(inner, depth - 1, 0)
        top = minima.left(conv, above)
        parent = begin[top] + above - common[top] - 1
        children = np.bincount(parent[inner], minlength=len(conv))
        total = np.concatenate(([0], np.cumsum(self.words, dtype=np.int64)))
        own = np.where(inner, self.words[np.where(inner, self.first[conv] + depth - 1, 0)] if len(self.words) else 0, 0)
        distinct = np.concatenate(([0], np.cumsum(own)))
        leaf = np.concatenate(([0], np.cumsum(np.append(common[1:], -1) < length)))
        shared = total[self.first[left] + above] - total[self.first[left]]
        saved = total[self.first[right + 1]] - total[self.first[left]] - size * shared
        saved -= distinct[begin[right + 1]] - distinct[np.arange(len(conv))]
        smallest = RangeMinima(self.ids).over(left, right)
        leaves = leaf[right + 1] - leaf[left]
        # Equal conversations stand in a row; those of a node end where the next one is longer.
        equal = np.concatenate((np.flatnonzero((common < length) | (np.append(-1, length[:-1]) != length)), [n]))
        stop = dict(zip(equal[:-1].tolist(), equal[1:].tolist()))

        edge = (left == 0) | (right == n - 1)
        keys = {}
        for i in {0, n - 1}:
            at = np.flatnonzero(edge & (conv == i))
            if len(at):
                names = _keys(self.path[i], int(depth[at].max()))
                keys.update(zip(at.tolist(), (names[d] for d in depth[at].tolist())))
        for i in np.flatnonzero(edge & (conv > 0) & (conv < n - 1)).tolist():  # prefixes of the last conversation
            keys[i] = b""
        tail = _keys(self.path[-1], int(length[-1]))
        keys = {i: k or tail[int(depth[i])] for i, k in keys.items()}

        ends = depth == length[conv]
        inside = np.flatnonzero(~edge)
        hashes = [
            hashlib.sha256(",".join(map(str, self.ids[conv[i] : stop[int(conv[i])]].tolist()) if ends[i] else "").encode()).hexdigest()
            for i in inside.tolist()]
        over = [keys.get(i) for i in parent[inside].tolist()]
        known = pa.array(smallest[parent[inside]], mask=np.array([k is not None for k in over], dtype=bool))
        columns = lambda at: {
            "conv_id": smallest[at], "depth": depth[at], "n_convs": size[at], "n_children": children[at],
            "n_leaves": leaves[at], "saved": saved[at]}
        yield _batch(len(inside), kind=[NODE] * len(inside), ends=hashes, parent=over, parent_conv_id=known, **columns(inside))
        outer = np.flatnonzero(edge)
        yield _batch(
            len(outer), kind=[PART] * len(outer), key=[keys[i] for i in outer.tolist()],
            parent=[keys[int(parent[i])] if depth[i] else None for i in outer.tolist()], **columns(outer))
        for i in outer[ends[outer]].tolist():
            whole = self.ids[conv[i] : stop[int(conv[i])]]
            yield _batch(len(whole), kind=[END] * len(whole), conv_id=whole, key=[keys[i]] * len(whole))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    ids, path, words = [], [], []
    turns = 0

    def made() -> Block:
        sizes_of = [len(w) for w in words]
        flat = np.concatenate(words) if words else np.zeros(0, np.int64)
        return Block(np.array(ids, dtype=np.int64), path, flat, np.concatenate(([0], np.cumsum(sizes_of))).astype(np.int64))

    for batch in batches:
        for conv, value, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            ids.append(conv)
            path.append(value.as_py())
            words.append(own.values.to_numpy(zero_copy_only=False).astype(np.int64))
            turns += len(words[-1])
            if len(ids) >= BLOCK or turns >= BLOCK_TURNS:
                yield made()
                ids, path, words, turns = [], [], [], 0
    if ids:
        yield made()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes, parts of nodes, ends and edges of one partition of sorted conversations."""
    task, last = TaskContext.get().partitionId(), None

    def edge(path: bytes, words: np.ndarray, side: int) -> pa.RecordBatch:
        return _batch(1, kind=[EDGE], task=[task], depth=[side], path=[path], words=[words.tolist()])

    for block in _blocks(batches):
        own = [block.words[block.first[i] : block.first[i + 1]] for i in (0, -2)]
        own[1] = block.words[block.first[-2] :]
        if last is None:
            yield edge(block.path[0], own[0], 0)
        else:
            yield border(*last, block.path[0])
        yield from block.nodes()
        last = block.path[-1], own[1]
    if last is not None:
        yield edge(*last, 1)


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for one, words, two in zip(*batch.columns):
            yield border(one.as_py(), words.values.to_numpy(zero_copy_only=False), two.as_py())


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key of rows sorted by key and id; the ids stream through it."""
    key, state = None, None
    done: list[tuple[bytes, str]] = []

    def given() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], names=["key", "ends"])

    for batch in batches:
        keys = batch.column(0).to_pylist()
        ids = batch.column(1).to_pylist()
        low = 0
        while low < len(keys):
            high = low
            while high < len(keys) and keys[high] == keys[low]:
                high += 1
            text = ",".join(map(str, ids[low:high])).encode()
            if keys[low] == key:
                state.update(b"," + text)
            else:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = keys[low], hashlib.sha256(text)
            low = high
        if done:
            yield given()
            done.clear()
    if key is not None:
        done.append((key, state.hexdigest()))
        yield given()


def trie(convs: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations, given as ``conv_id``, unique, with ``path`` and ``words``.

    Columns: ``conv_id``, the smallest member, ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    """
    spark = convs.sparkSession
    convs = written(convs.select("conv_id", "path", "words"), "paths")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-convs.count() // PER_PARTITION))
    laid_out = convs.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    pieces = written(laid_out.mapInArrow(_pieces, PIECES), "pieces")

    # One row for each edge of a partition: the edge before it is that of the partition before.
    before = Window.orderBy("task", "depth")
    edges = pieces.filter(F.col("kind") == EDGE).select(
        "depth", F.lag("path").over(before).alias("one"), F.lag("words").over(before).alias("words"), F.col("path").alias("two"))
    twice = edges.filter("depth = 0 AND one IS NOT NULL").select("one", "words", "two").mapInArrow(_borders, PIECES)
    parts_of = pieces.filter(F.col("kind") == PART).unionByName(twice)
    added = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    merged = written(parts_of.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), *added), "merged")

    ends = pieces.filter(F.col("kind") == END).select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    ends = written(ends.mapInArrow(_ends, "key binary, ends string"), "ends")
    names = merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    outer = merged.join(ends, "key", "left").join(small_side(names), "parent", "left").withColumn(
        "parent_conv_id", F.col("above")).withColumn("ends", F.coalesce("ends", none))
    inner = pieces.filter(F.col("kind") == NODE)
    under = inner.filter("parent IS NOT NULL").drop("parent_conv_id").join(small_side(names), "parent").withColumn(
        "parent_conv_id", F.col("above"))
    whole = inner.filter("parent IS NULL").select(*columns)
    return whole.unionByName(under.select(*columns)).unionByName(outer.select(*columns))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations of a table of turns."""
    return trie(paths(rebuilt(written(sequences(turns), "sequences"))))
