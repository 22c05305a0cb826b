"""Mixing sources to target weights by subset-sum budget fitting.

Every document has a size in words. A source's target is its share by weight of a total, but no
more than ``most`` times its own size; what a source cannot take is shared by weight among the
others. Documents are counted by exact size: every size first gives the same share of its
documents, and a bounded knapsack over what then is left of the budget picks single sizes so that
the sum is exact, or as near below it as sizes and the limit of ``most`` copies allow. Documents of
one size are taken equally often or once more; which ones follows from a seeded hash of id and text.

A null text has size 0; documents of size 0 are never taken. A null source is a source of its own,
the last one. Repeated rows are documents of their own; where only some of several rows with the
same id and text are taken, it is left open which. An empty table gives an empty mix.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.ranking import with_row_number
from .common import free_names, small_side, written

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SEED = 20240

# Words of the budget that the knapsack is solved for; what lies above is filled greedily first.
KNAPSACK = 1 << 16

# Hash bins in which the documents of one source and size are counted to cut them at a number.
BINS = 4096


def sizes(text: str = "text"):
    """Words of a text; runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes_of: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target``; weights repeat over sources in code point order.

    Which sources are capped is found by rounds that each raise the level (target per unit of
    weight) of the others; the driver sees only the sums of a round.
    """
    sums = sizes_of.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_row_number(sums.withColumn("last", F.col("source").isNull().cast("int")), ["last", "source"], "rank")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = written(ranked.select(
        "source", "source_size", F.element_at(listed, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight")
    ), "sources")
    limit = most * F.col("source_size")
    level, capped_before = 0.0, -1
    while True:
        capped = level * F.col("weight") > limit
        row = ranked.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(capped, limit)).alias("taken"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count(F.when(capped, 1)).alias("n"),
        ).first()
        if row["n"] == capped_before or not row["open"]:
            break
        capped_before = row["n"]
        level = (row["total"] - (row["taken"] or 0)) / row["open"]
    return ranked.select(
        "source", "source_size", F.least(limit.cast("double"), F.lit(level) * F.col("weight")).alias("target")
    )


def fit_budget(
    lengths: Sequence[int], counts: Sequence[int], budget: int, seed: int, most: int = 1, knapsack: int = KNAPSACK
) -> list[int]:
    """How often to take documents of each length so that the lengths add up to the budget.

    Every length first gives its share of the budget; what is left is filled by a bounded knapsack,
    in which no length is taken more than ``most`` times the documents it has. Where no sum is
    exact, more and more documents go back into the knapsack, up to its size. The result is the
    nearest sum found that is not above the budget.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    limits = [most * c for c in counts]
    quota = [min(m, c * budget // total) for m, c in zip(limits, counts)] if total else [0] * len(counts)
    left = budget - sum(n * q for n, q in zip(lengths, quota))
    order = list(range(len(lengths)))
    random.Random(seed).shuffle(order)
    for i in order:  # one pass of small steps brings what is left within the knapsack
        if left <= knapsack:
            break
        n = min(limits[i] - quota[i], -(-(left - knapsack) // lengths[i]), left // lengths[i])
        quota[i] += n
        left -= n * lengths[i]
    best, free = None, 0
    while True:
        own, goal = list(quota), left
        for i in order:
            n = min(own[i], -(-max(0, free - goal) // lengths[i]))
            if goal + n * lengths[i] <= knapsack:
                own[i] -= n
                goal += n * lengths[i]
        missed = _fill(lengths, limits, own, goal, order)
        if best is None or missed < best[0]:
            best = missed, own
        if missed == 0 or free > knapsack:
            return best[1]
        free = 4 * free or 256


def _fill(lengths: Sequence[int], limits: Sequence[int], quota: list[int], goal: int, order: Sequence[int]) -> int:
    """Add to the quotas the largest sum up to the goal, as a bounded knapsack finds it; what is missed."""
    if goal <= 0:
        return goal
    reached, full = 1, (1 << (goal + 1)) - 1
    how = np.full(goal + 1, -1, dtype=np.int64)  # the step that first reached a sum
    steps: list[tuple[int, int]] = []
    for i in order:
        spare, step = min(limits[i] - quota[i], goal // lengths[i]), 1
        while spare > 0 and not reached >> goal & 1:
            k = min(step, spare)
            new = (reached << k * lengths[i]) & full & ~reached
            if new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(goal // 8 + 1, "little"), np.uint8), bitorder="little")
                how[np.flatnonzero(bits)] = len(steps)
                steps.append((i, k))
                reached |= new
            spare, step = spare - k, step * 2
        if reached >> goal & 1:
            break
    at = reached.bit_length() - 1
    missed = goal - at
    while at > 0:
        i, k = steps[how[at]]
        quota[i] += k
        at -= k * lengths[i]
    return missed


def quotas(counted: DataFrame, most: int, seed: int) -> DataFrame:
    """For each source and size how often every document is taken, and how many once more.

    ``counted`` has a row per source and size; a task holds the sizes of one source.
    """

    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        lengths, counts = rows["size"].tolist(), rows["n"].tolist()
        taken = fit_budget(lengths, counts, int(rows["target"].iloc[0]), seed, most)
        return pd.DataFrame({
            "source": rows["source"], "size": lengths, "n": counts,
            "whole": [q // n for q, n in zip(taken, counts)], "more": [q % n for q, n in zip(taken, counts)],
        })

    schema = "source string, size long, n long, whole long, more long"
    return counted.groupBy("source").applyInPandas(plan, schema)


def _taken(
    docs: DataFrame, keep: Sequence[str], weights: Sequence[float], most: int, seed: int, source: str, text: str, doc_id: str
) -> DataFrame:
    """The ``keep`` columns of each row as ``k0``, ``k1``, ... with what ``mix`` gives."""
    kept = [f"k{i}" for i in range(len(keep))]
    own = lambda c: F.col(f"`{c}`")
    sized = written(docs.select(
        *[own(c).alias(k) for k, c in zip(kept, keep)], own(source).cast("string").alias("source"), sizes(text).alias("size"),
        F.xxhash64(F.lit(seed), own(doc_id), own(text)).alias("h"),
    ), "sizes")
    goal = written(targets(sized, weights, most), "targets")
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    counted = sized.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    counted = counted.alias("s").join(small_side(goal).alias("t"), same).select("s.*", "target")
    plan = written(quotas(counted, most, seed), "quotas")

    # Documents of a size of which some are taken once more: by bins of their hash, then within
    # the one bin in which the number is reached.
    bin_of = F.pmod(F.shiftrightunsigned("h", 48), F.lit(BINS)).cast("int")
    key = F.col("s.source").eqNullSafe(F.col("p.source")) & (F.col("s.size") == F.col("p.size"))
    rows = sized.withColumn("bin", bin_of).alias("s").join(small_side(plan).alias("p"), key, "left").select(
        "s.*", F.coalesce("whole", F.lit(0)).alias("whole"), F.coalesce("more", F.lit(0)).alias("more"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    partial = (F.col("more") > 0) & (F.col("more") < F.col("n"))
    bins = rows.filter(partial).groupBy("source", "size", "bin", "more").agg(F.count("*").alias("in_bin"))
    through = Window.partitionBy("source", "size").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    cut = bins.withColumn("before", F.coalesce(F.sum("in_bin").over(through), F.lit(0)))
    cut = cut.filter((F.col("before") < F.col("more")) & (F.col("before") + F.col("in_bin") >= F.col("more")))
    cut = written(cut.select("source", "size", F.col("bin").alias("cut_bin"), (F.col("more") - F.col("before")).alias("rest")), "cuts")
    key = F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.size") == F.col("c.size"))
    rows = rows.alias("r").join(small_side(cut).alias("c"), key, "left").select("r.*", "cut_bin", "rest")
    at_cut = F.col("bin") == F.col("cut_bin")
    simple = rows.filter(~F.coalesce(at_cut, F.lit(False))).withColumn(
        "extra", (F.col("more") > 0) & (F.col("cut_bin").isNull() | (F.col("bin") < F.col("cut_bin"))))
    within = Window.partitionBy("source", "size").orderBy("h")
    ranked = rows.filter(at_cut).withColumn("extra", F.row_number().over(within) <= F.col("rest"))
    taken = simple.unionByName(ranked).select(
        *kept, "source", "size", (F.col("whole") + F.col("extra").cast("long")).alias("copies"))
    return taken.alias("s").join(small_side(goal).alias("t"), same).select(
        *kept, "s.source", "size", "source_size", "target", "copies")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    source: str = "source",
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``copies`` of each document."""
    return _taken(docs, [doc_id], weights, most, seed, source, text, doc_id).withColumnRenamed("k0", "doc_id")


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the number of the copy.

    A row's own columns go with it, so rows without an id or with the same one are taken each by
    its own number of copies.
    """
    name, = free_names(docs, "copy")
    rows = _taken(docs, docs.columns, weights, most, seed, "source", "text", "doc_id").filter("copies > 0")
    columns = [F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)]
    return rows.select(*columns, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(name))
