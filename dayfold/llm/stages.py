"""Stages of the corpus pipeline: each takes documents and returns those it keeps.

All but the last return the columns of the documents. Where a stage changes texts, ``n_chars``, if
there is such a column, follows. Nulls, repeated rows and empty tables are treated as the operators
say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import classifier, decontamination, jaccard, mixing, pii
from .common import table

# Fixed values of the contract for near duplicates in a pipeline.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return classifier.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by shingles of five words and a similarity of
    0.8 or more: the one with the smallest id."""
    return jaccard.deduplicated(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, without the benchmark passages they still hold."""
    return _recounted(decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data."""
    return _recounted(pii.replace(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, with the number of the copy."""
    return mixing.mixed(docs)
