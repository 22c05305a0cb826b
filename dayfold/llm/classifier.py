"""Quality classifier: regularised quadratic discriminant over statistics of each document.

Statistics of whole texts are transformed to be roughly normal. Each class has a mean and a
covariance, which is shrunk towards the common one and towards a multiple of the identity; the
score is the posterior of class 1, from log densities that need only the inverse Cholesky factors
and their log determinants, which are computed once.

A null text counts as an empty one and gets a score like any other. Labels that are null or
neither 0 nor 1, and those of unknown documents, teach nothing; a document labelled twice counts
twice. Without training rows of both classes every score is the share of class 1, with one row
added to either class. Repeated rows get equal scores.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import map_batches, written
from .words import SPACED, Splitter, bytes_of, pieces

# Shrinkage of a class covariance towards the common one, and of the result towards the identity.
TO_COMMON, TO_IDENTITY = 0.25, 0.02

THRESHOLD = 0.7

FEATURES = (
    "log_words", "word_length", "lower", "upper", "digits", "marks", "symbols", "beyond_ascii",
    "distinct_words", "top_word", "distinct_triples", "distinct_lines", "line_words", "symbol_words",
)

# Kinds of bytes: lower case, upper case, digits, blanks, line ends, marks of prose, other symbols,
# first bytes of non-ASCII characters, their other bytes.
_KIND = np.full(256, 6, dtype=np.int64)
_KIND[ord("a") : ord("z") + 1], _KIND[ord("A") : ord("Z") + 1], _KIND[ord("0") : ord("9") + 1] = 0, 1, 2
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], _KIND[0x0A], _KIND[list(b".,;:'\"?-()")] = 3, 4, 5
_KIND[0xC0:], _KIND[0x80:0xC0] = 7, 8
_KINDS = 9

_LINES = np.ones(256, dtype=bool)
_LINES[0x0A] = False


def _share_distinct(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By text: distinct values per value, and the share of the most frequent value."""
    n = np.diff(first)
    distinct, top = np.ones(len(n)), np.zeros(len(n))
    for i in np.flatnonzero(n):
        run = np.sort(hashes[first[i] : first[i + 1]])
        edges = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1], [True])))
        distinct[i], top[i] = (len(edges) - 1) / n[i], np.diff(edges).max() / n[i]
    return distinct, top


class Statistics:
    """Turns texts into rows of transformed statistics; keeps its splitters between calls."""

    def __init__(self):
        self.words, self.lines = Splitter(SPACED, True), Splitter(_LINES, False)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        data, offsets = bytes_of(texts)
        out = [self._piece(data, offsets[a : b + 1]) for a, b in pieces(offsets)]
        return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))

    def _piece(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        words, lines = self.words.split(data, offsets), self.lines.split(data, offsets)
        text = np.repeat(np.arange(n), np.diff(offsets))
        kinds = _KIND[data[offsets[0] : offsets[-1]]]
        count = np.bincount(text * _KINDS + kinds, minlength=n * _KINDS).reshape(n, _KINDS)
        chars = np.maximum(count[:, :8].sum(axis=1), 1)
        n_words, n_lines = np.diff(words.first), np.diff(lines.first)
        last = kinds[words.end - 1] == 6 if len(words.end) else np.zeros(0, dtype=bool)
        ends = np.concatenate(([0], np.cumsum(last)))
        triples, at = self.words.grams(words, 3)
        distinct, top = _share_distinct(words.hash, words.first)
        root = lambda share: np.arcsin(np.sqrt(np.clip(share, 0, 1)))
        return np.column_stack([
            np.log1p(n_words),
            np.log1p(chars / np.maximum(n_words, 1)),
            *[root(count[:, k] / chars) for k in (0, 1, 2, 5, 6, 7)],
            root(distinct), root(top),
            root(_share_distinct(triples, np.searchsorted(at, words.first))[0]),
            root(_share_distinct(lines.hash, lines.first)[0]),
            np.log1p(n_words / np.maximum(n_lines, 1)),
            root((ends[words.first[1:]] - ends[words.first[:-1]]) / np.maximum(n_words, 1)),
        ])


def statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of each document and ``x``, its transformed statistics."""
    picked = docs.select(*keep, F.col(f"`{text}`").alias("__text"))
    held: list[Statistics] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Statistics())
        rows = held[0](batch.column(len(keep)))
        x = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], x], names=[*keep, "x"])

    schema = T.StructType([*picked.schema.fields[: len(keep)], T.StructField("x", T.ArrayType(T.DoubleType()))])
    return map_batches(picked, run, schema)


class Discriminant(NamedTuple):
    """A fitted model: per class its prior, mean, inverse Cholesky factor and log determinant."""

    classes: list[tuple[float, np.ndarray, np.ndarray, float]] | None
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1 of each row."""
        if self.classes is None:
            return np.full(len(x), self.share)
        logs = []
        for prior, mean, inverse, log_det in self.classes:
            z = (x - mean) @ inverse.T  # its squared length is the Mahalanobis distance
            logs.append(np.log(prior) - 0.5 * (z * z).sum(axis=1) - 0.5 * log_det)
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def moments(rows: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Count, sum and sum of outer products of ``x`` for each ``quality``, added up by Spark."""
    d = len(FEATURES)

    def partial(batches):
        sums = {k: np.zeros(1 + d + d * d) for k in (0, 1)}
        for batch in batches:
            if not len(batch):
                continue
            x = batch.column(1).flatten().to_numpy().reshape(-1, d)
            kind = batch.column(0).to_numpy(zero_copy_only=False)
            for k, total in sums.items():
                own = x[kind == k]
                total += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
        for k, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()), pa.array(total)],
                names=["k", "i", "v"],
            )

    added = rows.select("quality", "x").mapInArrow(partial, "k int, i int, v double").groupBy("k", "i").agg(F.sum("v").alias("v"))
    out = {}
    for k in (0, 1):
        flat = np.zeros(1 + d + d * d)
        for r in added.filter(F.col("k") == k).collect():  # 1 + d + d * d rows
            flat[r["i"]] = r["v"]
        out[k] = (int(round(flat[0])), flat[1 : 1 + d], flat[1 + d :].reshape(d, d))
    return out


def fit(rows: DataFrame, to_common: float = TO_COMMON, to_identity: float = TO_IDENTITY) -> Discriminant:
    """Fit the discriminant to rows of ``quality`` (0 or 1) and ``x``."""
    sums = moments(rows)
    n = {k: s[0] for k, s in sums.items()}
    share = (n[1] + 1) / (n[0] + n[1] + 2)
    if min(n.values()) == 0:
        return Discriminant(None, share)
    means = {k: s / c for k, (c, s, _) in sums.items()}
    scatter = {k: q - np.outer(means[k], means[k]) * c for k, (c, _, q) in sums.items()}
    common = sum(scatter.values()) / sum(n.values())
    scale = np.sqrt(np.maximum(np.diag(common), 1e-6))  # statistics are compared in like units
    common = common / np.outer(scale, scale)
    classes = []
    for k in (0, 1):
        own = scatter[k] / n[k] / np.outer(scale, scale)
        mixed = (1 - to_common) * own + to_common * common
        mixed = (1 - to_identity) * mixed + to_identity * np.eye(len(mixed))
        factor = np.linalg.cholesky(mixed)
        inverse = np.linalg.inv(factor) / scale
        classes.append((n[k] / sum(n.values()), means[k], inverse, 2 * float(np.log(np.diag(factor)).sum())))
    return Discriminant(classes, share)


def training_rows(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Labelled statistics of the rows that may teach: those that are not held out."""
    own = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("quality"))
    own = own.filter(F.col("quality").isin(0, 1) & ~held_out("__id"))
    return stats.join(own, F.col(f"`{doc_id}`") == F.col("__id")).select("quality", "x")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept for testing: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def scored(stats: DataFrame, model: Discriminant) -> DataFrame:
    """Rows with ``score`` in place of their statistics."""
    at = stats.columns.index("x")
    columns = [c for c in stats.columns if c != "x"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column(at).flatten().to_numpy().reshape(-1, len(FEATURES))
        return pa.RecordBatch.from_arrays(
            [*(c for i, c in enumerate(batch.columns) if i != at), pa.array(model.score(x))], names=[*columns, "score"]
        )

    schema = T.StructType([*(f for f in stats.schema if f.name != "x"), T.StructField("score", T.DoubleType())])
    return map_batches(stats, run, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each document."""
    stats = written(statistics(docs, ["doc_id"]), "statistics")
    model = fit(training_rows(stats, labels))
    return scored(stats, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Documents, with their own columns, whose score reaches the threshold."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("__rest"),
                         F.col(f"`{text}`").alias("__text"), F.col("doc_id").alias("__id"))
    stats = written(statistics(docs.select("doc_id", text), ["doc_id"], text), "statistics")
    model = fit(training_rows(stats, labels))
    held: list[Statistics] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Statistics())
        return batch.filter(pa.array(model.score(held[0](batch.column(1))) >= threshold))

    kept = map_batches(packed, run, packed.schema)
    return kept.select(*[
        F.col("__text").alias(c) if c == text else F.col(f"__rest.`{c}`").alias(c) for c in docs.columns
    ])
