"""Live queue state from a stream of status events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model import DAY
from ..operators.keyed import keep_last
from ..operators.queue import fold_status
from ..session import work_path
from ..sources.results import remove


# Batches after which the saved changes are put together into one.
BATCHES_KEPT = 50


def status_stream(
    events: DataFrame, path: str, checkpoint: str, day: Sequence[str] = DAY, ts: str = "ts", seq: str = "seq"
) -> StreamingQuery:
    """Fold new status events into the state of their days, then stop.

    State is one row per day, whatever the number of events, and events may come late or out of
    order. Each micro-batch writes the days that changed to a folder of its own number, so a batch
    that is repeated overwrites what it wrote before, and the latest row of a day is its state.
    """

    def save(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        if epoch % BATCHES_KEPT == BATCHES_KEPT - 1:
            compact_status(batch.sparkSession, path, epoch, day)

    return (
        fold_status(events, day, ts, seq)
        .writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact_status(spark: SparkSession, path: str, epoch: int, day: Sequence[str] = DAY) -> None:
    """Put the changes up to a batch together: the state as of then takes their place.

    The state is written first, as that batch's, and only then are earlier folders deleted; stopped
    in between, they hold nothing but rows that later ones replace.
    """
    work = work_path(spark, "status")
    saved = spark.read.parquet(path).filter(F.col("epoch") <= epoch)
    earlier = [r["epoch"] for r in saved.select("epoch").distinct().collect() if r["epoch"] < epoch]
    keep_last(saved, list(day), ["epoch"]).drop("epoch").write.parquet(work)
    spark.read.parquet(work).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    for number in earlier:  # as many as batches since the last time
        remove(spark, f"{path}/epoch={number}")
    remove(spark, work)


def current_status(spark: SparkSession, path: str, day: Sequence[str] = DAY) -> DataFrame:
    """The latest saved state of every day."""
    return keep_last(spark.read.parquet(path), list(day), ["epoch"]).drop("epoch")
