"""First N, global row numbers, fixed chunks and scalar lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import work_path


def first_distinct(df: DataFrame, columns: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` distinct rows in order, found as a top-n without a full sort."""
    return df.select(*columns).distinct().orderBy(*order).limit(n)


def latest(df: DataFrame, moment: str, n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``n`` latest rows; rows without a moment come first, as in a descending SQL sort."""
    return df.orderBy(F.col(moment).desc_nulls_first(), *tie_break).limit(n)


def scalar(df: DataFrame, column: str, default=None, name: str = "value") -> DataFrame:
    """One row with one value: the column's value in the only row, or the default."""
    return df.select(column).limit(1).agg(
        F.coalesce(F.first(column), F.lit(default)).alias(name)
    )


def with_row_number(df: DataFrame, order: Sequence[str], name: str = "row_no") -> DataFrame:
    """Dense global numbers 0, 1, 2, ... in an order whose last column is unique.

    Rows are range-partitioned and sorted, so no task holds them all, and written to the shared
    folder with their partition and their place in it. Each partition's numbers start where the
    partition before it ends; the table of starts has one row per partition.
    """
    spark = df.sparkSession
    path = work_path(spark, "row-number")
    per_partition = 1 << 33  # monotonically_increasing_id counts from 0 in each such range
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__place", F.monotonically_increasing_id() % F.lit(per_partition))
        .write.parquet(path)
    )
    laid_out = spark.read.parquet(path)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        laid_out.groupBy("__part")
        .agg(F.count("*").alias("__n"))
        .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    return (
        laid_out.join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + F.col("__place"))
        .drop("__part", "__place", "__start")
    )


def chunk_number(row_no: str | Column, size: int) -> Column:
    """Number of the chunk of ``size`` rows that a row is in."""
    row = F.col(row_no) if isinstance(row_no, str) else row_no
    return F.floor(row / F.lit(size)).cast("long")


def with_chunks(df: DataFrame, order: Sequence[str], size: int, name: str = "chunk") -> DataFrame:
    """Number the rows in order and assign them to chunks of ``size``."""
    numbered = with_row_number(df, order)
    return numbered.withColumn(name, chunk_number("row_no", size))
