"""Lempel-Ziv phrase fingerprints.

A text is parsed into phrases, each the longest one known so far and one byte more; the set of
phrases is what a compressor would learn from it. Phrases are hashed, and the smallest hashes make
the fingerprint: two texts are alike as far as their sets of phrases have the same members, which
the signatures estimate, or tell exactly while they hold the whole sets.

A null text is an empty one; it has no phrases and an empty fingerprint, is like another empty one
(1) and unlike any other (0). Equal texts have equal fingerprints. In ``compared_with_next`` rows
with a null id come last, and rows with equal ids in the order of their texts, nulls first; the
only row of a table is its own next one. Whole texts are parsed; a task holds a few megabytes of
texts at a time, or one longer text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import folder_bytes
from .words import mix

# Hashes kept of a text.
SIZE = 128

# Bytes of texts whose phrases are hashed together.
CHUNK = 1 << 21

_U = np.uint64
_STEP, _ROOT = _U(0x9E3779B97F4A7C15), _U(0x2545F4914F6CDD1D)


class Phrases:
    """The phrases of a text as a tree: node i + 1 is entry i, whose key holds its parent and byte."""

    def __init__(self):
        self.tree: dict[int, int] = {}
        self.node = 0

    def feed(self, data: bytes) -> Phrases:
        tree, node = self.tree, self.node
        get = tree.get
        for byte in data:
            key = node << 8 | byte
            node = get(key, 0)
            if not node:
                tree[key] = len(tree) + 1
        self.node = node
        return self

    def fork(self) -> Phrases:
        """A copy that may go on with another text."""
        other = Phrases()
        other.tree, other.node = self.tree.copy(), self.node
        return other


class Forest:
    """Trees of several texts, whose phrases are hashed together."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.bases: list[tuple[int, int]] = []  # per part: its place less that of node 1, and that of an earlier part
        self.heads: list[int] = []
        self.size = 1  # the root

    def add(self, phrases: Phrases, since: int = 0, base: int = 0) -> int:
        """Entries of a tree from number ``since`` on; the earlier ones lie at ``base``. Returns their place."""
        n = len(phrases.tree) - since
        place = self.size
        self.keys.append(np.fromiter(islice(phrases.tree, since, None), np.int64, n))
        self.bases.append((place - since, base))
        self.heads.append(since)
        self.size += n
        return place

    def hashes(self) -> np.ndarray:
        """The hash of every entry, from those of their parents: level by level."""
        parent, byte = np.zeros(self.size, np.int64), np.zeros(self.size, dtype=_U)
        at = 1
        for keys, (own, earlier), since in zip(self.keys, self.bases, self.heads):
            node = keys >> 8
            parent[at : at + len(keys)] = np.where(node == 0, 0, np.where(node <= since, earlier, own) + node - 1)
            byte[at : at + len(keys)] = (keys & 255).astype(_U)
            at += len(keys)
        out = np.full(self.size, _ROOT)
        known = np.zeros(self.size, dtype=bool)
        known[0] = True
        todo = np.arange(1, self.size)
        while len(todo):
            ready = known[parent[todo]]
            now = todo[ready]
            out[now] = mix(out[parent[now]] * _STEP + byte[now])
            known[now] = True
            todo = todo[~ready]
        return out


def signature(hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The smallest hashes, their upper halves, in order."""
    if len(hashes) > size:
        hashes = np.partition(hashes, size - 1)[:size]
    return np.unique((hashes >> _U(32)).astype(np.uint32))


def shown(values: np.ndarray) -> str:
    return base64.b64encode(values.astype(">u4").tobytes()).decode()


def read(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype=">u4")


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Share of the phrases that both have, among the smallest hashes of either."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate((a, b))
    both.sort()
    twice = both[:-1] == both[1:]
    distinct = len(both) - int(twice.sum())
    if distinct <= size:
        return int(twice.sum()) / distinct
    unique = both[np.concatenate(([True], ~twice))]
    return int((both[:-1][twice] <= unique[size - 1]).sum()) / size


def signatures(texts: Sequence[bytes], size: int = SIZE) -> list[np.ndarray]:
    forest, places = Forest(), []
    for text in texts:
        phrases = Phrases().feed(text)
        places.append((forest.add(phrases), len(phrases.tree)))
    hashes = forest.hashes()
    return [signature(hashes[a : a + n], size) for a, n in places]


def fingerprint(text: Column, size: int = SIZE) -> Column:
    """The fingerprint of a text column."""

    @F.pandas_udf("string")
    def udf(texts: pd.Series) -> pd.Series:
        out, chunk, held = [], [], 0
        for text in texts:
            data = text.encode() if text else b""
            chunk.append(data)
            held += len(data)
            if held >= CHUNK:
                out += map(shown, signatures(chunk, size))
                chunk, held = [], 0
        return pd.Series(out + list(map(shown, signatures(chunk, size))))

    return udf(text)


def similarity(a: Column, b: Column, size: int = SIZE) -> Column:
    """Likeness of two fingerprint columns."""

    @F.pandas_udf("double")
    def udf(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([likeness(read(p), read(q), size) for p, q in zip(x, y)], dtype="float64")

    return udf(a, b)


def _ranges(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, int]:
    """Documents dealt out by ranges of falling ids, each with the first document of the next range.

    The driver sees one id per range; the ranges follow from the size of the table.
    """
    spark = docs.sparkSession
    size = folder_bytes(docs)
    size = 0 if size > 1 << 60 else size  # what Spark says of a frame that is not a table
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size >> 27, 1)
    n = 4 * tasks
    ids = docs.select(F.col(f"`{doc_id}`").alias("i"))
    cuts = ids.agg(F.percentile_approx("i", [k / n for k in range(1, n)], 20 * n)).first()[0]
    bounds = spark.sparkContext.broadcast(np.unique(np.array(cuts or [], dtype=np.int64)))

    @F.pandas_udf("int")
    def range_of(i: pd.Series) -> pd.Series:
        last = len(bounds.value)
        place = last - np.searchsorted(bounds.value, i.fillna(0).to_numpy(np.int64), "left")
        return pd.Series(np.where(i.isna(), last + 1, place), dtype="int32")

    heads = {r["r"]: r["i"] for r in ids.groupBy(range_of("i").alias("r")).agg(F.max("i").alias("i")).collect()}
    used = sorted(heads)
    before = dict(zip(used, used[-1:] + used[:-1]))
    # The first document of each range goes to the range before as well; ids are unique to a range.
    wanted = spark.createDataFrame(
        [(heads[r], r, before[r]) for r in used], "__head long, __range int, __before int") if used else None
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    own = own.withColumn("range", range_of("doc_id"))
    if wanted is None:
        return own.withColumn("extra", F.lit(False)), tasks
    same = F.col("doc_id").eqNullSafe(F.col("__head")) & (F.col("range") == F.col("__range"))
    marked = own.join(F.broadcast(wanted), same, "left")  # as many rows as there are ranges
    dealt = marked.select("doc_id", "text", F.explode(F.array_compact(F.array(
        F.struct(F.col("range").alias("range"), F.lit(False).alias("extra")),
        F.when(F.col("__before").isNotNull(), F.struct(F.col("__before").alias("range"), F.lit(True).alias("extra"))),
    ))).alias("to"))
    return dealt.select("doc_id", "text", "to.range", "to.extra"), tasks


def compared_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how like they and the next one's are.

    The next document is that with the next smaller id, after the last the first. In the edited
    text the last third of the characters is replaced by as many first ones of the next document.
    """
    dealt, tasks = _ranges(docs, doc_id, text)
    in_order = dealt.repartition(tasks, "range").sortWithinPartitions(
        "range", "extra", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")

    def compare(rows: list[tuple], known: np.ndarray | None) -> tuple[pa.RecordBatch, np.ndarray]:
        """Results of all rows but the last, and the signature of the last."""
        forest, parts, out = Forest(), [], []
        for k, (_, _, body, extra) in enumerate(rows):
            if k == len(rows) - 1 or extra:
                phrases = Phrases().feed(body.encode())
                parts.append((forest.add(phrases), len(phrases.tree), 0, 0, 0, b""))
                continue
            cut = len(body) // 3
            kept, new = body[: len(body) - cut], rows[k + 1][2][:cut]
            head = Phrases().feed(kept.encode())
            n_head = len(head.tree)
            fork = head.fork().feed(new.encode())
            whole = head.feed(body[len(body) - cut :].encode())
            at = forest.add(whole)
            parts.append((at, len(whole.tree), n_head, forest.add(fork, n_head, at), len(fork.tree) - n_head, (kept + new).encode()))
        hashes = forest.hashes()
        own = [signature(hashes[a : a + n], size) for a, n, *_ in parts]
        if known is not None:
            own[0] = known
        for k, (_, number, body, extra) in enumerate(rows[:-1]):
            if extra:
                continue
            at, _, n_head, tail, n_tail, edited = parts[k]
            other = signature(np.concatenate((hashes[at : at + n_head], hashes[tail : tail + n_tail])), size)
            out.append((
                number, len(body), hashlib.sha256(edited).hexdigest(), shown(own[k]), shown(other),
                likeness(own[k], other, size), likeness(own[k], own[k + 1], size)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        columns = list(zip(*out)) if out else [[]] * 7
        names = [x.split()[0] for x in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names), own[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        known, held = None, 0
        for batch in batches:
            for number, body, where, extra in zip(*(c for c in batch.columns)):
                rows.append((where.as_py(), number.as_py(), body.as_py() or "", extra.as_py()))
                held += len(rows[-1][2])
                if held >= CHUNK and len(rows) > 1:
                    done, known = compare(rows, known)
                    yield done
                    rows, held = rows[-1:], len(rows[-1][2])
        if len(rows) > 1:
            yield compare(rows, known)[0]

    return in_order.select("doc_id", "text", "range", "extra").mapInArrow(run, schema)
