"""Hard negatives of embeddings by bounds along spanning trees of anchors.

A score is an integer inner product. Anchors are put in trees: those with one label and like signs
of their first components come together, and a tree spans them by its shortest edges. For the root
all candidates are scored. From an anchor to its child a candidate's score changes by no more than
the length of the edge times the candidate's norm, so the parent's score, or the bounds already known
of it, plus and minus that product bound the child's. Only candidates whose bounds overlap the
child's window are scored again; the others keep their bounds, from which the child's own children
go on. The window for positives starts at the k-th largest of the lower bounds, that for negatives is
the stated share of the scores of the anchor's positives. Bounds leave out only what cannot be in the
result, so the result is exact.

Anchors are a stated query set: all of them meet all rows, in cells of a bundle of trees and a group
of rows, both of bounded size, which meet by a shuffle on the cell's number. A cell gives at most so
many rows per anchor, which are merged by a limit per group that starts before the shuffle.

Rows with a null id or label, a null vector or any null or non-finite component take no part. Rows
that repeat id, label and vector count once; an anchor is never its own positive or negative, nor is
a row with its id. Ties go to the smaller id. Vectors of different lengths are filled up with zeros.
Scores are exact as whole numbers of 64 bits; a score that does not fit is an error. Other columns
are not looked at. An empty table, or one without anchors, has no result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.ranking import with_row_number
from .common import written

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95

# Anchors of a tree, trees of a bundle, rows of a group.
TREE, BUNDLE, GROUP = 512, 16, 1 << 14

# Components that a vector is turned into whole numbers by.
SCALE = 256.0

_TREES = "tree long, ids array<long>, labels array<long>, dim long, vectors binary, parent array<int>, edge array<double>"


def valid(rows: DataFrame, vec_id: Column, label: Column, vector: Column) -> DataFrame:
    """Distinct rows that take part, as ``id``, ``label`` and ``vector``, in a written table."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    picked = rows.select(vec_id.cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector"))
    return written(picked.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").filter(finite).distinct(), "vectors")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows of whole numbers in floating point, filled up with zeros."""
    array = column.combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    length = array.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.floor(SCALE * array.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(length), int(length.max(initial=0))))
    out[np.arange(out.shape[1]) < length[:, None]] = flat
    return out


def _widened(matrix: np.ndarray, dim: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, dim - matrix.shape[1]))) if matrix.shape[1] < dim else matrix


class Scores:
    """Exact inner products with a set of candidates."""

    def __init__(self, candidates: np.ndarray):
        self.rows, self.most = candidates, float(np.abs(candidates).max(initial=0))
        self.norms = np.sqrt((candidates * candidates).sum(axis=1))

    def __call__(self, at: np.ndarray | None, vector: np.ndarray) -> np.ndarray:
        rows = self.rows if at is None else self.rows[at]
        if self.most * float(np.abs(vector).max(initial=0)) * max(1, len(vector)) < 2.0**53:
            return (rows @ vector).astype(np.int64)
        whole = [int(x) for x in vector]
        return np.array([sum(int(x) * y for x, y in zip(row, whole)) for row in rows], dtype=object).astype(np.int64)


def span(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parents and edges of the shortest tree that spans the vectors from the first one on."""
    n = len(vectors)
    parent, edge = np.full(n, -1, dtype=np.int32), np.zeros(n)
    near, of = np.full(n, np.inf), np.zeros(n, dtype=np.int32)
    at, left = 0, np.ones(n, dtype=bool)
    left[0] = False
    for _ in range(n - 1):
        away = np.sqrt(((vectors - vectors[at]) ** 2).sum(axis=1))
        closer = away < near
        near[closer], of[closer] = away[closer], at
        at = int(np.where(left, near, np.inf).argmin())
        parent[at], edge[at], left[at] = of[at], near[at], False
    return parent, edge


def _planted(table: pa.Table) -> pa.Table:
    """One tree of the anchors of a group."""
    vectors = _matrix(table.column("vector"))
    parent, edge = span(vectors)
    return pa.table({
        "tree": pa.array([table.column("tree")[0].as_py()], pa.int64()),
        "ids": pa.array([table.column("id").to_pylist()], pa.list_(pa.int64())),
        "labels": pa.array([table.column("label").to_pylist()], pa.list_(pa.int64())),
        "dim": pa.array([vectors.shape[1]], pa.int64()), "vectors": pa.array([vectors.tobytes()], pa.binary()),
        "parent": pa.array([parent.tolist()], pa.list_(pa.int32())), "edge": pa.array([edge.tolist()], pa.list_(pa.float64())),
    })


def trees(anchors: DataFrame) -> DataFrame:
    """Trees of anchors, a row each; anchors near one another are likely to share one."""
    signs = F.aggregate(F.slice("vector", 1, 16), F.lit(0), lambda a, x: a * 2 + (x > 0).cast("int"))
    order = ["label", "signs", "id", "mark"]
    marked = anchors.withColumn("signs", signs).withColumn("mark", F.xxhash64("id", "label", "vector"))
    numbered = with_row_number(marked, order, "row_no").withColumn("tree", F.floor(F.col("row_no") / TREE).cast("long"))
    return written(numbered.select("tree", "id", "label", "vector").groupBy("tree").applyInArrow(_planted, _TREES), "trees")


def walk(
    parent: np.ndarray, edge: np.ndarray, vectors: np.ndarray, scores: Scores,
    pick: Callable[[int, np.ndarray, np.ndarray], np.ndarray], take: Callable[[int, np.ndarray, np.ndarray], None],
) -> int:
    """Go from each anchor to its children; how many candidates were scored.

    ``pick`` tells from lower and upper bounds which candidates an anchor needs; ``take`` gets them
    and their scores. Bounds of an anchor are given up after its last child.
    """
    children: list[list[int]] = [[] for _ in parent]
    for j, p in enumerate(parent.tolist()):
        if p >= 0:
            children[p].append(j)
    bounds, waiting, scored = {}, [0], 0
    while waiting:
        j = waiting.pop()
        v, p = vectors[j], int(parent[j])
        if p < 0:
            exact = scores(None, v)
            low = high = exact.astype(np.float64)
            at = np.flatnonzero(pick(j, low, high))
            own, scored = exact[at], scored + len(exact)
        else:
            # The bit more covers the rounding of the bounds themselves.
            slack = scores.norms * (edge[j] * (1 + 1e-9) + 1e-9 * (np.sqrt((v * v).sum()) + 1)) + 1e-6
            low, high = bounds[p][0] - slack, bounds[p][1] + slack
            bounds[p][2] -= 1
            if not bounds[p][2]:
                del bounds[p]
            at = np.flatnonzero(pick(j, low, high))
            own, scored = scores(at, v), scored + len(at)
            low[at] = high[at] = own
        take(j, at, own)
        if children[j]:
            bounds[j] = [low, high, len(children[j])]
            waiting += children[j]
    return scored


def _best(own: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, the smaller id first among equal ones."""
    if len(own) > 4 * k:
        least = np.partition(own, len(own) - k)[len(own) - k]
        some = np.flatnonzero(own >= least)
        return some[np.lexsort((ids[some], -own[some]))[:k]]
    return np.lexsort((ids, -own))[:k]


def _unpacked(row: dict, dim: int) -> tuple:
    vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(len(row["ids"]), row["dim"])
    return row["ids"], row["labels"], _widened(vectors, dim), np.array(row["parent"]), np.array(row["edge"])


def _cell(work: Callable) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Let every tree of a cell work on the cell's rows."""

    def run(rows: pa.Table, bundle: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in work.columns}
        if rows.num_rows:
            ids, labels = (rows.column(c).to_numpy() for c in ("id", "label"))
            own = _matrix(rows.column("vector"))
            listed = bundle.to_pylist()
            dim = max([own.shape[1], *(t["dim"] for t in listed)])
            scores = Scores(_widened(own, dim))
            for row in listed:
                work(row, _unpacked(row, dim), ids, labels, scores, out)
        return pa.table({name: pa.array(out[name], kind) for name, kind in work.columns.items()})

    return run


class _Positives:
    columns = {"tree": pa.int64(), "place": pa.int32(), "id": pa.int64(), "score": pa.int64()}
    schema = "tree long, place int, id long, score long"

    def __init__(self, k: int):
        self.k = k

    def __call__(self, row, tree, ids, labels, scores, out) -> None:
        anchors, own_labels, vectors, parent, edge = tree

        def pick(j, low, high):
            mine = (labels == own_labels[j]) & (ids != anchors[j])
            known = low[mine]
            if len(known) > self.k:
                mine &= high >= np.partition(known, len(known) - self.k)[len(known) - self.k]
            return mine

        def take(j, at, own):
            for i in _best(own, ids[at], self.k).tolist():
                for name, value in zip(self.columns, (row["tree"], j, int(ids[at[i]]), int(own[i]))):
                    out[name].append(value)

        walk(parent, edge, vectors, scores, pick, take)


class _Negatives:
    columns = {
        "tree": pa.int64(), "place": pa.int32(), "nth": pa.int32(), "anchor_id": pa.int64(), "positive_id": pa.int64(),
        "positive_score": pa.int64(), "negative_id": pa.int64(), "negative_score": pa.int64()}
    schema = (
        "tree long, place int, nth int, anchor_id long, positive_id long, positive_score long, "
        "negative_id long, negative_score long")

    def __init__(self, k: int, low: int, high: int):
        self.k, self.low, self.high = k, low, high

    def __call__(self, row, tree, ids, labels, scores, out) -> None:
        anchors, own_labels, vectors, parent, edge = tree
        windows: dict[int, list] = {}
        for p in row["positives"]:
            first, last = -(-self.low * p["score"] // 100), self.high * p["score"] // 100
            if first <= last:
                windows.setdefault(p["place"], []).append((first, last, p))

        def pick(j, low, high):
            wanted = np.zeros(len(ids), dtype=bool)
            for first, last, _ in windows.get(j, ()):
                wanted |= (high >= first) & (low <= last)
            return wanted & (labels != own_labels[j]) & (ids != anchors[j])

        def take(j, at, own):
            for first, last, p in windows.get(j, ()):
                inside = np.flatnonzero((own >= first) & (own <= last))
                for i in inside[_best(own[inside], ids[at[inside]], self.k)].tolist():
                    values = (row["tree"], j, p["nth"], anchors[j], p["id"], p["score"], int(ids[at[i]]), int(own[i]))
                    for name, value in zip(self.columns, values):
                        out[name].append(value)

        walk(parent, edge, vectors, scores, pick, take)


def _first(df: DataFrame, keys: list[str], score: str, name: str, k: int, rank: str) -> DataFrame:
    """The k rows of each group with the largest scores, numbered from 1."""
    best = Window.partitionBy(*keys).orderBy(F.col(score).desc(), name)
    return df.withColumn(rank, F.row_number().over(best)).filter(F.col(rank) <= k)


def mine(
    rows: DataFrame, anchor: Column, vec_id: Column, label: Column, vector: Column,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``anchor`` tells from ``id`` and ``label`` which rows are anchors. Of the rows with another label
    whose score is between ``low`` and ``high`` percent of a positive's, the best are its negatives.
    """
    table = valid(rows, vec_id, label, vector)
    spark, n = table.sparkSession, table.count()
    planted = trees(table.filter(anchor))
    bundles = max(1, -(-planted.count() // BUNDLE))
    groups = max(-(-n // GROUP), 2 * spark.sparkContext.defaultParallelism)
    group = F.pmod(F.xxhash64("id", "label", "vector"), F.lit(groups))
    dealt = table.select("*", group.alias("group"), F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle")).select(
        "id", "label", "vector", (F.col("bundle") * groups + F.col("group")).cast("long").alias("cell")).groupBy("cell")

    def met(work, of: DataFrame) -> DataFrame:
        bundle = F.floor(F.col("tree") / BUNDLE)
        spread = of.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")).withColumn(
            "cell", (bundle * groups + F.col("group")).cast("long")).drop("group")
        return dealt.cogroup(spread.groupBy("cell")).applyInArrow(_cell(work), work.schema)

    best = written(_first(met(_Positives(positives), planted), ["tree", "place"], "score", "id", positives, "nth"), "positives")
    of_tree = best.groupBy("tree").agg(F.collect_list(F.struct("place", "nth", "id", "score")).alias("positives"))
    found = met(_Negatives(negatives, low, high), planted.join(of_tree, "tree"))
    ranked = _first(found, ["tree", "place", "nth"], "negative_score", "negative_id", negatives, "rank")
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
