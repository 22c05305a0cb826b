"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import work_path

# A table with at most so many bytes in its files may be broadcast; larger ones are shuffled.
BROADCAST_BYTES = 48 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table written to the shared folder: computed once, and lineage ends there."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folder_bytes(df: DataFrame) -> int:
    """Bytes that Spark reckons with for a frame; for a table just read, those of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_side(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A written table as the side of a join: broadcast if its files are small, else shuffled."""
    return F.broadcast(df) if folder_bytes(df) <= most else df


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that the frame does not have, made from the wanted ones."""
    taken = {c.lower() for c in df.columns}
    made = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        made.append(name)
    return made


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply a function to each Arrow batch; it returns one batch or several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = function(batch)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out

    return df.mapInArrow(run, schema)
