"""The corpus pipeline: documents pass the stages in order, each over all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dayfold.llm import stages
from dayfold.llm.common import table, written

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", stages.quality),
    ("n-gram Jaccard join", stages.near_duplicates),
    ("benchmark decontamination", stages.decontaminated),
    ("PII surrogates", stages.surrogates),
    ("mixing to target weights", stages.mixed),
]

# SQL cannot express the fitted classifier, the surrogates or the seeded mix; tests compare the
# stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every stage is written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
