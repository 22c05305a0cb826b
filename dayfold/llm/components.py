"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for all nodes of links (a, b).

    In each round a node takes the smallest label among its neighbours, and then the label of that
    label, so the way to the smallest node is halved. Every round is written; the driver sees only
    whether anything changed. Nodes with many links are counted by partial sums and joined as the
    side that may be split.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        of_end = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        nearest = both.join(of_end, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        moved = written(labels.join(nearest, "node", "left").select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("label")), "labels")
        jump = moved.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = written(moved.join(jump, "label", "left").select(
            "node", "before", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        if new.filter(F.col("label") != F.col("before")).isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
