"""Substring removal with prefix-partitioned suffix trees.

Every window of ``window`` words that also starts earlier, in a document with a smaller id or
before it in its own, is a repeat, and its words go. Two suffixes are below one node at the depth of
the window exactly if their windows are equal, so every node there with more than one suffix is a
repeat, and its first suffix in document order is what stays.

The tree is never built whole. Suffixes are dealt to groups by a prefix: the shortest of ``PREFIXES``
with few enough suffixes to fit in memory. It is a prefix of the words at the suffix's anchor (below),
which equal windows have at the same place, so that suffixes that follow one another mostly go to one
group and their words are sent once for all of them; where a whole anchor leaves too many, it is the
whole window. One task builds each group's subtree: it sorts the suffixes by their words, takes the
common prefixes of neighbours and makes the nodes with a stack. Where even the window leaves too many,
as with a passage that a third of all documents share, there is nothing left to split: that group is
one node, and its first suffix is found by partial minima.

``repeats`` needs no node below the window, so suffixes are cut to it. ``maximal_repeats`` follows
suffixes as far as they repeat, and gives the deep nodes themselves.

Three steps keep down what has to move, none of which can lose a repeat:
* A document with the same words as one with a smaller id is a repeat as a whole.
* Each window has an anchor, the smallest of the hashes of its runs of ``RUN`` words. Equal windows
  have equal anchors, so only windows whose anchor stands in more than one place can repeat.
* A window that a document has twice is told by that document alone.

Words are runs of anything but ASCII white space. A null or empty text has no words. A null id comes
before all others. Rows with equal ids count as one document for what is earlier, but each loses its
own words only. Hashes only deal suffixes to groups and pick candidates; suffixes are compared by
their words, whole documents by a 128-bit digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import free_names, map_batches, small_side, written
from .words import SPACED, Splitter, bytes_of, pieces

WINDOW, RUN = 20, 8

# Lengths of prefixes by which suffixes are grouped, besides the whole anchor and the whole window.
PREFIXES = (2, 5)

# Suffixes of a group: at least, and at most, so that it fits in a task's memory.
FEWEST, MOST = 1_000, 250_000
BUCKETS = 1 << 20

# Largest filter of anchors that is sent to the tasks. With more anchors each document gets its own
# list of them by a join.
FILTER_BYTES = 64 << 20

# What is told of each document.
OUT = ("n_words", "n_removed", "kept")

# Stands for a null id, so that it is the first in order.
NO_ID = -(1 << 63)

_U = np.uint64


def _identity(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _sub(identity: bytes) -> int:
    return int.from_bytes(identity[:4], "big", signed=True)


def _picked(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("id"), F.col(f"`{text}`").alias("text"))


def _marks(docs: DataFrame) -> DataFrame:
    """``id``, number of words ``n`` and identity ``sid`` of each document's words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, ids = [], []
        for value in batch.column(1):
            words = value.as_buffer().to_pybytes().split() if value.is_valid else []
            n.append(len(words))
            ids.append(_identity(words))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], names=["id", "n", "sid"])

    return map_batches(docs, run, "id long, n long, sid binary")


class Windows:
    """Windows of documents and their anchors, piece by piece; keeps its splitter between calls."""

    def __init__(self, window: int, run: int):
        self.window, self.run, self.splitter = window, min(run, window), Splitter(SPACED, False)

    def __call__(self, texts: pa.Array) -> Iterator[tuple]:
        """First document of a piece, its words, and per window: start, document, anchor's hash and place."""
        data, offsets = bytes_of(texts)
        span = self.window - self.run + 1
        for low, high in pieces(offsets):
            words = self.splitter.split(data, offsets[low : high + 1])
            grams, at = self.splitter.grams(words, self.run)
            if len(grams) < span:
                yield low, words, *[np.zeros(0, np.int64)] * 2, np.zeros(0, _U), np.zeros(0, np.int64)
                continue
            doc = np.searchsorted(words.first, at, "right") - 1
            view = np.lib.stride_tricks.sliding_window_view(grams, span)
            whole = np.flatnonzero(doc[span - 1 :] == doc[: len(view)])
            place = view.argmin(axis=1)[whole] + whole
            yield low, words, at[whole], doc[whole], grams[place], at[place]


def _filter_bits(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return h % _U(bits), (h >> _U(32)) * _U(0x9E3779B97F4A7C15) % _U(bits)


def _anchors(docs: DataFrame, window: int, run: int) -> DataFrame:
    """Hashes of anchors that stand in more than one place, and in how many."""
    held: list[Windows] = []

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Windows(window, run))
        for _, _, _, _, hashes, places in held[0](batch.column(1)):
            _, once = np.unique(places, return_index=True)
            found, n = np.unique(hashes[once], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["h", "n"])

    return map_batches(docs, count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1")


def _with_own_anchors(docs: DataFrame, anchors: DataFrame, window: int, run: int) -> DataFrame:
    """Documents that have repeated anchors, with these: the way without a filter."""
    held: list[Windows] = []

    def own(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Windows(window, run))
        ids, texts = batch.column(0).to_numpy(), batch.column(1)
        for low, _, _, doc, hashes, _ in held[0](texts):
            pair = np.unique(np.rec.fromarrays([doc, hashes]))
            rows = low + pair["f0"]
            key = [hashlib.blake2b(texts[int(r)].as_buffer(), digest_size=16).digest() for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows]), pa.array(key, pa.binary()), pa.array(pair["f1"].view(np.int64))], names=["id", "key", "h"])

    def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
        key = [hashlib.blake2b(t.as_buffer(), digest_size=16).digest() if t.is_valid else None for t in batch.column(1)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(key, pa.binary())], names=["id", "text", "key"])

    found = map_batches(docs, own, "id long, key binary, h long").distinct().join(anchors.select("h"), "h")
    lists = written(found.groupBy("id", "key").agg(F.collect_list("h").alias("anchors")), "anchors")
    return map_batches(docs, keyed, "id long, text string, key binary").join(lists, ["id", "key"]).select("id", "text", "anchors")


class _Candidates:
    """Picks the windows of a batch whose anchor may be repeated."""

    def __init__(self, window: int, run: int, table: np.ndarray | None):
        self.windows, self.table = Windows(window, run), table

    def __call__(self, batch: pa.RecordBatch):
        """Per piece: first document, words, and start, anchor's place and document of each such window."""
        own = None if self.table is not None else batch.column(2)
        for low, words, start, doc, hashes, place in self.windows(batch.column(1)):
            if own is None:
                hit = np.ones(len(hashes), dtype=bool)
                for bit in _filter_bits(hashes, len(self.table) * 64):
                    hit &= (self.table[(bit >> _U(6)).astype(np.int64)] >> (bit & _U(63))) & _U(1) == 1
            else:
                hit = np.zeros(len(hashes), dtype=bool)
                edges = np.searchsorted(doc, np.arange(len(words.first)))
                for i in np.flatnonzero(np.diff(edges)):
                    listed = np.array(own[low + int(i)].as_py(), dtype=np.int64).view(_U)
                    hit[edges[i] : edges[i + 1]] = np.isin(hashes[edges[i] : edges[i + 1]], listed)
            yield low, words, start[hit], place[hit], doc[hit]

    def prefix(self, words, start: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the k words from each start."""
        hashes, at = self.windows.splitter.grams(words, k)
        return hashes[np.searchsorted(at, start)]

    def prefixes(self, words, start: np.ndarray, place: np.ndarray) -> Iterator[np.ndarray]:
        """Hashes of the prefixes by which suffixes are dealt, level by level."""
        for k in (*(k for k in PREFIXES if k < self.windows.run), self.windows.run):
            yield self.prefix(words, place, k)
        yield self.prefix(words, start, self.windows.window)


def _filter(anchors: DataFrame, n: int) -> np.ndarray | None:
    """A filter of the anchors as 64-bit words, or none if it would be too large."""
    words = max(64, 1 << (n * 32 // 64).bit_length())
    if words * 8 > FILTER_BYTES:
        return None
    bits = words * 64

    def places(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for bit in _filter_bits(batch.column(0).to_numpy().view(_U), bits):
            yield pa.RecordBatch.from_arrays(
                [pa.array((bit >> _U(6)).astype(np.int64)), pa.array((_U(1) << (bit & _U(63))).view(np.int64))], names=["w", "b"])

    table = np.zeros(words, dtype=_U)
    rows = map_batches(anchors.select("h"), places, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    table[rows.column("w").to_numpy()] = rows.column("b").to_numpy().view(_U)
    return table


def _grouping(rows: DataFrame, pick, n: int, levels: int) -> np.ndarray:
    """For every length of prefix the buckets that are small enough to be a group, as a table."""
    most = min(MOST, max(FEWEST, n // 256))
    buckets = min(BUCKETS, 1 << (4 * n // most).bit_length())

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        candidates = pick()
        for _, words, start, place, _ in candidates(batch):
            for level, hashes in enumerate(candidates.prefixes(words, start, place)):
                bucket, many = np.unique(hashes % _U(buckets), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(bucket), level, np.int32)), pa.array(bucket.astype(np.int64)), pa.array(many, pa.int64())],
                    names=["level", "bucket", "n"])

    full = map_batches(rows, count, "level int, bucket long, n long").groupBy("level", "bucket").agg(F.sum("n").alias("n"))
    fits = np.ones((levels, buckets), dtype=bool)
    over = full.filter(F.col("n") > most).select("level", "bucket").toArrow()  # a bounded number of counters
    fits[over.column("level").to_numpy(), over.column("bucket").to_numpy()] = False
    return fits


def _spaced(texts: pa.Array, words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a piece with one blank between them, and where each starts and ends in that."""
    data, _ = bytes_of(texts)
    size = words.end - words.start
    before = np.cumsum(size) - size
    first = before + np.arange(len(size))
    at = np.arange(int(size.sum()))
    out = np.full(len(at) + len(size), 0x20, dtype=np.uint8)
    out[at + np.repeat(np.arange(len(size)), size)] = data[at + np.repeat(words.start - before, size)]
    return out.tobytes(), first, first + size


def _suffixes(rows: DataFrame, pick, fits, window: int, every: bool) -> DataFrame:
    """Candidate suffixes with their group, and per document the starts of windows it has twice.

    A suffix's group is its level and bucket in one number; a negative one is a full bucket of whole
    windows. ``n`` suffixes of one group that follow one another are a row: ``start`` of the first, and
    ``words`` of all their windows, with one blank between them. With ``every``, each suffix is a row,
    windows that a document has twice are suffixes like others, and ``before`` is the word before each.
    """
    schema = "id long, sub int, part long, words binary, start int, n int, before binary, again array<int>"

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        candidates, small = pick(), fits.value
        ids, texts = batch.column(0).to_numpy(), batch.column(1)
        for low, words, start, place, doc in candidates(batch):
            if not len(start):
                continue
            part = np.full(len(start), -1, dtype=np.int64)
            open_ = np.ones(len(start), dtype=bool)
            for level, whole in enumerate(candidates.prefixes(words, start, place)):  # the last are whole windows
                bucket = (whole % _U(small.shape[1])).astype(np.int64)
                now = open_ & small[level][bucket]
                part[now] = bucket[now] * len(small) + level
                open_ &= ~now
            spaced, begins, ends = _spaced(texts.slice(low, len(words.first) - 1), words)
            of = lambda first, last: spaced[begins[first] : ends[last + window - 1]]
            # Of equal windows in one document only the first goes on.
            order = np.lexsort((start, whole, doc))
            same = np.flatnonzero((whole[order][1:] == whole[order][:-1]) & (doc[order][1:] == doc[order][:-1]))
            pairs = zip(start[order[same]].tolist(), start[order[same + 1]].tolist())
            same = same[np.array([of(a, a) == of(b, b) for a, b in pairs], dtype=bool)]
            later = order[:0] if every else order[same + 1]
            first = np.ones(len(start), dtype=bool)
            first[later] = False
            subs = {int(d): _sub(_identity(texts[low + int(d)].as_buffer().to_pybytes().split())) for d in np.unique(doc)}
            sub = np.array([subs[d] for d in doc.tolist()], dtype=np.int32)
            begin = (start - words.first[doc]).astype(np.int32)
            before = [spaced[a:b] if k else None for k, a, b in zip(
                begin.tolist(), begins[start - 1].tolist(), ends[start - 1].tolist())] if every else []
            own = np.flatnonzero(first)
            follows = np.zeros(len(own), dtype=bool)
            if not every and len(own):
                a, b = own[:-1], own[1:]
                follows[1:] = (start[b] == start[a] + 1) & (doc[b] == doc[a]) & (part[b] == part[a]) & (part[b] >= 0)
            head = np.flatnonzero(~follows)
            n = np.diff(np.append(head, len(own)))
            head, tail = own[head], own[head + n - 1]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[low + doc[head]]), pa.array(sub[head]), pa.array(part[head]),
                pa.array([of(a, b) for a, b in zip(start[head].tolist(), start[tail].tolist())], pa.binary()),
                pa.array(begin[head]), pa.array(n.astype(np.int32)),
                pa.array(before, pa.binary()) if every else pa.nulls(len(head), pa.binary()), pa.nulls(len(head), pa.list_(pa.int32()))],
                names=["id", "sub", "part", "words", "start", "n", "before", "again"])
            twice = np.unique(doc[later])
            if len(twice):
                own = [np.sort(begin[later][doc[later] == d]).tolist() for d in twice]
                none = [pa.nulls(len(twice), kind) for kind in (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[low + twice]), pa.array([subs[int(d)] for d in twice], pa.int32()), *none,
                    pa.array(own, pa.list_(pa.int32()))], names=["id", "sub", "part", "words", "start", "n", "before", "again"])

    return map_batches(rows, run, schema)


def common_words(a: bytes, b: bytes) -> int:
    """How many whole words two suffixes have in common from their start."""
    if a == b:
        return a.count(b" ") + 1
    short = min(len(a), len(b))
    low, step = 0, 64
    while low < short and a[low : low + step] == b[low : low + step]:  # stretches that double
        low, step = min(low + step, short), 2 * step
    high = min(low + step, short)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    at_end = all(low == len(x) or x[low] == 0x20 for x in (a, b)) and low > 0
    return a.count(b" ", 0, low) + at_end


def deep_nodes(leaves: Iterator[tuple[bytes, object]], least: int, merge) -> Iterator[tuple[int, object, bytes]]:
    """Nodes of a suffix tree that are at least so deep, from its leaves in the order of their words.

    A leaf has its words and what it carries; equal leaves are one node. Gives each node's depth, what
    its leaves carry, merged, and the words of one of them. The stack holds the path of open nodes.
    """
    stack: list[list] = []
    last = None

    def close(depth: int) -> Iterator[tuple[int, object, bytes]]:
        held = None
        while stack and stack[-1][0] > depth:
            at, own = stack.pop()
            held = own if held is None else merge(own, held)
            yield at, held, last
        if held is not None and depth >= least:
            if stack and stack[-1][0] == depth:
                stack[-1][1] = merge(stack[-1][1], held)
            else:
                stack.append([depth, held])

    for words, carried in leaves:
        shared = 0 if last is None else common_words(last, words)
        yield from close(shared if shared >= least else 0)
        size = words.count(b" ") + 1
        if stack and stack[-1][0] == size:
            stack[-1][1] = merge(stack[-1][1], carried)
        elif size >= least:
            stack.append([size, carried])
        last = words
    yield from close(0)


def _subtree(window: int):
    """Suffixes of one group that are not the first below their node at window depth."""

    def run(suffixes: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for text, id_, start, sub, n in suffixes[["words", "id", "start", "sub", "n"]].itertuples(index=False, name=None):
            words = text.split(b" ") if n > 1 else [text]
            rows.extend((b" ".join(words[i : i + window]), id_, start + i, sub) for i in range(n))
        rows.sort(key=lambda row: row[0])
        leaves = ((words, [(id_, start, sub)]) for words, id_, start, sub in rows)
        later = []
        for _, places, _ in deep_nodes(leaves, window, lambda a, b: a.extend(b) or a):
            if len(places) > 1:
                first = min(places)[:2]
                later.extend(p for p in places if p[:2] != first)
        return pd.DataFrame({
            "id": pd.array([p[0] for p in later], "int64"), "sub": pd.array([p[2] for p in later], "int32"),
            "start": pd.array([p[1] for p in later], "int32")})

    return run


def _spans(window: int):
    """Starts of windows of a document as stretches of words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for starts in batch.column(2):
            s = np.unique(np.array(starts.as_py(), dtype=np.int64))
            cut = np.flatnonzero(np.diff(s) > window)
            first, last = s[np.concatenate(([0], cut + 1))], s[np.concatenate((cut, [len(s) - 1]))] + window
            out.append([{"first": a, "end": b} for a, b in zip(first.tolist(), last.tolist())])
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], names=["id", "sub", "spans"])

    return run


def _dealt(own: DataFrame, window: int, run: int, every: bool) -> tuple[DataFrame, DataFrame]:
    """Suffixes of the documents with their groups, and as spans the documents that are copies."""
    spark, run = own.sparkSession, min(run, window)
    marks = written(_marks(own).filter(F.col("n") >= window), "marks")
    firsts = marks.groupBy("sid").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first <> last")
    copies = marks.join(written(firsts, "copied"), "sid").filter("id > first")
    copies = written(copies.select("id", "n", F.conv(F.hex(F.substring("sid", 1, 4)), 16, -10).cast("long").alias("u"), "sid").distinct(), "copies")
    sub = F.when(F.col("u") >= 1 << 31, F.col("u") - (1 << 32)).otherwise(F.col("u")).cast("int")
    whole = copies.select("id", sub.alias("sub"), F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n").alias("end"))).alias("spans"))
    # An id of a copy is left out as a whole unless other rows have it too.
    mixed = marks.groupBy("id").agg(F.countDistinct("sid").alias("c")).filter("c > 1").select("id")
    out = written(copies.select("id").distinct().join(mixed, "id", "left_anti"), "left-out")
    rest = own.join(small_side(out), "id", "left_anti")

    anchors = written(_anchors(rest, window, run), "anchors")
    n, places = anchors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    table = _filter(anchors, n)
    sent = spark.sparkContext.broadcast(table)
    rows = rest if table is not None else _with_own_anchors(rest, anchors, window, run)
    held: list[_Candidates] = []

    def pick() -> _Candidates:
        if not held:
            held.append(_Candidates(window, run, sent.value))
        return held[0]

    levels = sum(k < run for k in PREFIXES) + 2
    fits = _grouping(rows, pick, places * (window - run + 1) // 2, levels)
    suffixes = written(_suffixes(rows, pick, spark.sparkContext.broadcast(fits), window, every), "suffixes")
    return suffixes, whole


def repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Stretches of words that go: ``id`` (a null one as ``NO_ID``), ``sub``, which tells rows with
    one id apart, and ``spans`` of words, first and end."""
    suffixes, whole = _dealt(_picked(docs, text, doc_id), window, run, False)
    in_groups = suffixes.filter("part >= 0").select("id", "sub", "part", "words", "start", "n")
    trees = in_groups.groupBy("part").applyInPandas(_subtree(window), "id long, sub int, start int")
    full = suffixes.filter("part < 0").select("id", "sub", "words", "start")
    place = F.struct("id", "start")
    nodes = full.groupBy("words").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last")
    nodes = written(nodes.select("words", "first"), "full-nodes")
    hot = full.join(nodes, "words").filter(place != F.col("first")).select("id", "sub", "start")
    later = trees.union(hot).select("id", "sub", F.array("start").alias("again"))
    again = suffixes.filter("again IS NOT NULL").select("id", "sub", "again")
    starts = later.union(again).groupBy("id", "sub").agg(F.flatten(F.collect_list("again")).alias("starts"))
    return map_batches(starts, _spans(window), whole.schema).unionByName(whole)


def _followed(window: int):
    """Suffixes of a document from each listed opening to where it stops repeating."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for id_, value, lists in zip(*(batch.column(i) for i in range(3))):
            words = value.as_buffer().to_pybytes().split()
            sub, rows = _sub(_identity(words)), []
            for places in lists.as_py():
                if places["sub"] != sub:
                    continue
                opens = {p["start"]: p["opens"] for p in places["places"]}
                end = -1
                for start in sorted(opens, reverse=True):
                    end = end if start + 1 in opens else start + window
                    if opens[start]:
                        rows.append((start, words[start : start + window], words[start:end], words[start - 1] if start else None))
            yield pa.RecordBatch.from_arrays([
                pa.array([id_.as_py()] * len(rows), pa.int64()), pa.array([sub] * len(rows), pa.int32()),
                pa.array([r[0] for r in rows], pa.int32()), pa.array([b" ".join(r[1]) for r in rows], pa.binary()),
                pa.array([b" ".join(r[2]) for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary())],
                names=["id", "sub", "start", "node", "words", "before"])

    return run


def _joined(a: tuple, b: tuple) -> tuple:
    """What two sets of places have together: number, number with a word before, least and greatest of these, first place."""
    lows, highs = ([x for x in pair if x is not None] for pair in ((a[2], b[2]), (a[3], b[3])))
    return a[0] + b[0], a[1] + b[1], min(lows, default=None), max(highs, default=None), min(a[4], b[4])


def _maximal(window: int):
    """Deep nodes of one subtree whose places do not all have one and the same word before them."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("words")
        leaves = ((r.words, (r.n, r.befores, r.low, r.high, (r.id, r.start))) for r in rows.itertuples())
        out = []
        for depth, (n, befores, low, high, place), words in deep_nodes(leaves, window, _joined):
            if n > 1 and (n > befores or low != high):
                out.append((b" ".join(words.split(b" ")[:depth]).decode(), depth, n, *place))
        return pd.DataFrame(out, columns=["words", "n_words", "n_places", "id", "start"])

    return run


def maximal_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Maximal repeats of at least ``window`` words, one row each: its ``words`` with one blank between
    them, ``n_words``, ``n_places``, and ``id`` and ``start`` of the first place.

    A repeat stands in two places or more and gets fewer by any word before or after it. Documents
    with the same words are one text, that of the smallest id; a null id is ``NO_ID``. No repeat is
    cut: a suffix is followed as long as its windows repeat, which is past the end of every repeat
    that begins with it. Only suffixes are followed at whose windows a repeat can begin, as not all
    places have the same word before. Equal suffixes are counted before they are sent on, so a task
    gets the different repeated continuations of one window.
    """
    own = _picked(docs, text, doc_id)
    suffixes, copies = _dealt(own, window, run, True)
    suffixes = suffixes.join(copies.select("id", "sub"), ["id", "sub"], "left_anti").dropDuplicates(["id", "sub", "start"])
    befores = [F.count("before").alias("befores"), F.min("before").alias("low"), F.max("before").alias("high")]
    nodes = suffixes.groupBy("words").agg(F.count("*").alias("n"), *befores).filter("n > 1")
    nodes = written(nodes.select("words", (F.expr("n > befores") | (F.col("low") != F.col("high"))).alias("opens")), "deep-nodes")
    places = suffixes.join(nodes, "words").groupBy("id", "sub").agg(F.collect_list(F.struct("start", "opens")).alias("places"))
    lists = written(places.groupBy("id").agg(F.collect_list(F.struct("sub", "places")).alias("lists")), "repeat-places")
    schema = "id long, sub int, start int, node binary, words binary, before binary"
    followed = map_batches(own.filter("text IS NOT NULL").join(lists, "id"), _followed(window), schema)
    leaves = followed.dropDuplicates(["id", "sub", "start"]).groupBy("node", "words").agg(
        F.count("*").alias("n"), *befores, F.min(F.struct("id", "start")).alias("place"))
    leaves = leaves.select("node", "words", "n", "befores", "low", "high", "place.id", "place.start")
    return leaves.groupBy("node").applyInPandas(
        _maximal(window), "words string, n_words long, n_places long, id long, start int")


def _kept(docs: DataFrame, spans: DataFrame, keep: list[str], window: int, text: str, doc_id: str) -> DataFrame:
    """``keep`` columns with ``n_words``, ``n_removed`` and the ``kept`` words, joined by blanks."""
    lists = written(spans.groupBy("id").agg(F.collect_list(F.struct("sub", "spans")).alias("gone")), "removals")
    own = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("text"),
                      F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("id"))
    joined = own.join(small_side(lists), "id", "left").select(*[f"k{i}" for i in range(len(keep))], "text", "gone")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, gone, kept = [], [], []
        for value, spans in zip(batch.column(len(keep)), batch.column(len(keep) + 1)):
            words = value.as_buffer().to_pybytes().split() if value.is_valid else []
            out = words
            if spans.is_valid and len(words) >= window:
                sub = _sub(_identity(words))
                stays = np.ones(len(words), dtype=bool)
                for row in spans.as_py():
                    if row["sub"] == sub:
                        for span in row["spans"]:
                            stays[span["first"] : span["end"]] = False
                out = [words[i] for i in np.flatnonzero(stays)]
            n.append(len(words))
            gone.append(len(words) - len(out))
            kept.append(b" ".join(out))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[: len(keep)], pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=[*batch.schema.names[: len(keep)], "n_words", "n_removed", "kept"])

    schema = joined.select(*[f"k{i}" for i in range(len(keep))], F.lit(0).cast("long").alias("n_words"),
                           F.lit(0).cast("long").alias("n_removed"), F.col("text").alias("kept")).schema
    own_names = [F.col(c).alias(n) for c, n in zip(OUT, free_names(docs.select(*[F.col(f"`{c}`") for c in keep]), *OUT))]
    return map_batches(joined, run, schema).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *own_names)


def without_repeats(docs: DataFrame, keep: list[str], window: int = WINDOW, run: int = RUN, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``keep`` columns of each document with ``n_words``, ``n_removed`` and the ``kept`` words; where a
    column of ``keep`` has such a name, the new one gets ``_`` at its end."""
    return _kept(docs, repeats(docs, window, run, text, doc_id), keep, window, text, doc_id)
