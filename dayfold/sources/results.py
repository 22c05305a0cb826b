"""Result tables and keyed tables in Parquet."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..model import DAY
from ..operators import keyed
from ..operators.quality import require_columns
from ..session import work_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of its own file system."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data that a job made itself."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def write_result(df: DataFrame, path: str) -> None:
    """Write a result; parent folders are made, an old result of that name is replaced."""
    df.write.mode("overwrite").parquet(path)


def load_classified(
    spark: SparkSession, path: str, keys: Sequence[str] = ("meta_id", "year", "month", "day")
) -> DataFrame:
    """A classified set; raises if it is missing or lacks a key column."""
    df = spark.read.parquet(path)
    require_columns(df, keys, "classified data")
    return df


def append_day(df: DataFrame, path: str, days: Sequence[str] = DAY) -> None:
    """Append rows to a table without a key, partitioned by day.

    The rebalance hint gives each day files of the advisory size: small days are merged into one
    file, a day that holds most of the rows is split.
    """
    df.hint("rebalance", *days).write.mode("append").partitionBy(*days).parquet(path)


# Columns that tell the batches of a table and the attempts at each apart; batches that are listed in
# at most so many rows are broadcast to the scan.
BATCH = ["batch", "attempt"]
LISTED_BATCHES = 100_000


def _committed(spark: SparkSession, path: str) -> DataFrame:
    """The attempt that counts for each batch: the one committed last.

    Every commit has a moment; comparing it lets Spark take the list for one worth pruning by.
    """
    commits = read_table(spark, f"{path}_batches", T.StructType(
        [T.StructField(c, T.StringType()) for c in BATCH] + [T.StructField("at", T.LongType())]))
    return commits.filter("at > 0").groupBy("batch").agg(F.max_by("attempt", F.struct("at", "attempt")).alias("attempt"))


def append_batch(df: DataFrame, path: str, batch: str, days: Sequence[str] = DAY) -> None:
    """Append rows once, however often it is called with one batch id.

    Each call writes a folder of its own and then a row beside the table that names it. Until that
    row is there readers do not see the rows, and from then on they see them in place of those of an
    earlier call with the same id; the earlier folder is deleted afterwards. A call that fails leaves
    the table as it was.
    """
    if not re.fullmatch(r"[\w.-]+", batch, re.ASCII):
        raise ValueError(f"a batch id is made of letters, digits, '_', '.' and '-': {batch!r}")
    spark, attempt = df.sparkSession, uuid.uuid4().hex
    folder = f"{path}/batch={batch}"
    before = [r["attempt"] for r in _committed(spark, path).filter(F.col("batch") == batch).collect()]
    df.hint("rebalance", *days).write.partitionBy(*days).parquet(f"{folder}/attempt={attempt}")
    row = spark.createDataFrame([(batch, attempt, time.time_ns())], "batch string, attempt string, at long")
    row.coalesce(1).write.mode("append").parquet(f"{path}_batches")
    for old in before:
        remove(spark, f"{folder}/attempt={old}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed batches; folders of attempts that do not count are not read."""
    committed = _committed(spark, path)
    if not exists(spark, path) or committed.isEmpty():
        return spark.createDataFrame([], schema)
    told = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in BATCH]])
    rows = spark.read.schema(told).parquet(path)
    few = committed.count() <= LISTED_BATCHES
    return rows.join(F.broadcast(committed) if few else committed, BATCH, "left_semi").select(*schema.fieldNames())


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, or an empty one of the same schema where nothing is stored yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_days(
    spark: SparkSession, path: str, schema: T.StructType, rows: DataFrame, days: Sequence[str] = DAY
) -> DataFrame | None:
    """The part of a day-partitioned table whose days occur in some rows, None if there is none.

    The days are named in a partition filter, so no other partition is read. There are as many of
    them as the calendar has, however many rows there are.
    """
    if not exists(spark, path):
        return None
    months: dict[tuple, list] = {}
    for day in rows.select(*days).dropna().distinct().collect():
        months.setdefault(tuple(day)[:-1], []).append(day[-1])

    def in_month(head: tuple, last: list) -> Column:
        same = [F.col(c) == v for c, v in zip(days, head)]
        return reduce(lambda a, b: a & b, [*same, F.col(days[-1]).isin(sorted(last))])

    wanted = reduce(lambda a, b: a | b, [in_month(h, d) for h, d in months.items()], F.lit(False))
    part = read_table(spark, path, schema).filter(wanted)
    return None if part.isEmpty() else part


def rows_of_days(
    spark: SparkSession, path: str, schema: T.StructType, rows: DataFrame, days: Sequence[str] = DAY
) -> DataFrame:
    """The rows of a day-partitioned table on the days that occur in other rows.

    The days are found while the query runs and prune the partitions then; the driver does not see
    them. There are no more of them than the calendar has, so they are broadcast. Comparing the
    year lets Spark take the list for one worth pruning by; rows without a whole day match nothing.
    """
    wanted = rows.select(*days).dropna().filter(F.col(days[0]) > 0).distinct()
    return read_table(spark, path, schema).join(F.broadcast(wanted), list(days), "left_semi").select(*schema.fieldNames())


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    schema: T.StructType,
    keys: Sequence[str],
    now,
    defaults: dict | None = None,
    days: Sequence[str] = DAY,
    keep: bool = False,
) -> str | None:
    """Upsert a batch into a table partitioned by day, and return the folder of merged days.

    The batch, one row per key, is written once so that it is computed once. If the table has
    none of its days, as with a new day's drops, the new partitions are written straight to it
    and nothing is returned. Otherwise only those days are read, merged in the shared folder,
    and then replace their partitions. A failure before the last step leaves the table as it
    was; after a failure in it, calling ``publish`` again with the folder of merged days, or this
    function with the same batch, repairs the table. The intermediate folders are deleted when all
    is done, unless ``keep`` is set. Upserts into the same days must not run at the same time.
    """
    work = work_path(spark, "upsert")
    batch.write.parquet(f"{work}/batch")
    staged = spark.read.schema(batch.schema).parquet(f"{work}/batch")
    old = read_days(spark, path, schema, staged, days)
    if old is None:
        fresh = keyed.upsert(spark.createDataFrame([], schema), staged, keys, now, defaults)
        _replace_days(fresh.hint("rebalance", *days), path, days)
        if not keep:
            remove(spark, work)
        return None
    merged = keyed.upsert(old, staged, keys, now, defaults).hint("rebalance", *days)
    merged.write.partitionBy(*days).parquet(f"{work}/merged")
    publish(spark, f"{work}/merged", path, schema, days)
    if not keep:
        remove(spark, work)
    return f"{work}/merged"


def replace_days(df: DataFrame, path: str, days: Sequence[str] = DAY) -> None:
    """Store rows in place of what the table holds of their days; repeating it changes nothing."""
    _replace_days(df.hint("rebalance", *days), path, days)


def _replace_days(df: DataFrame, path: str, days: Sequence[str]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*days)
        .parquet(path)
    )


def publish(
    spark: SparkSession, merged: str, path: str, schema: T.StructType, days: Sequence[str] = DAY
) -> None:
    """Replace the partitions of a table that ``merged`` holds; all others stay."""
    _replace_days(read_table(spark, merged, schema), path, days)
