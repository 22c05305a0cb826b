"""Incremental ingest: each new drop file is upserted once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..model import DAY, KINDS, Kind
from ..operators.keyed import keep_last
from ..plans.ingest import store
from ..session import work_path
from ..sources.drops import FILE_ORDER, scan_files, sort_out, unreadable
from ..sources.results import read_days, upsert_table

# Files of one micro-batch. Results do not depend on it.
FILES_PER_BATCH = 5000


def arrivals(spark: SparkSession, root: str, pattern: str, files_per_batch: int) -> DataFrame:
    """A stream of the names of new files. Their bytes are not read, so drifting types do no harm."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
        .select("path", "length")
    )


ORDER_FIELDS = [T.StructField("source_filename", T.StringType()), T.StructField("row_index", T.LongType())]


def order_path(table: str) -> str:
    """Where the drop and row that each stored row came from are kept."""
    return f"{table.rstrip('/')}_order"


def _order_schema(kind: Kind) -> T.StructType:
    return T.StructType([*(kind.schema[k] for k in kind.key), *ORDER_FIELDS])


def _newest(session: SparkSession, fine: DataFrame, kind: Kind, table: str) -> DataFrame:
    """The newest row of each key, unless the stored row came from a later drop."""
    newest = keep_last(fine, kind.key, FILE_ORDER)
    stored = read_days(session, order_path(table), _order_schema(kind), newest, DAY)
    if stored is None:
        return newest
    at = F.struct(*[f.name for f in ORDER_FIELDS])
    known = stored.select(*[F.col(k).alias(f"__{k}") for k in kind.key], at.alias("__at"))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in kind.key])
    return newest.join(known, same, "left").filter(F.col("__at").isNull() | (at >= F.col("__at"))).select(*fine.columns)


def ingest_stream(
    spark: SparkSession,
    root: str,
    kind: str,
    table: str,
    checkpoint: str,
    now,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Upsert the drops that arrived since the last run, then stop.

    Of the rows of one key the one in the last drop by name wins, in whatever order and batches
    drops arrive: the drop and row that a stored row came from are kept beside the table, and rows
    older than those are left out. A batch that is repeated after a failure gives the same table
    and the same rejects. ``now`` is called once per batch. Rejects are kept as by ``store``, one
    folder per batch.
    """
    wanted = KINDS[kind]

    def load(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        scanned, bad = scan_files(batch, kind=wanted)
        fine, refused = sort_out(scanned, wanted)
        path = work_path(session, "arrived")
        _newest(session, fine, wanted, table).write.parquet(path)
        rows = session.read.schema(fine.schema).parquet(path)
        store(session, rows, refused.unionByName(unreadable(bad)), wanted, table, now(), f"batch-{epoch}")
        schema = _order_schema(wanted)
        upsert_table(session, order_path(table), rows.select(*schema.fieldNames()), schema, wanted.key, now())

    return (
        arrivals(spark, root, f"*_{kind}.parquet", files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
