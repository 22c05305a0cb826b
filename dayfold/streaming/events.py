"""Streams of dated rows: duplicates within a bounded delay, and counts per time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def without_duplicates(
    events: DataFrame, keys: Sequence[str], ts: str = "ts", delay: str = "1 hour"
) -> DataFrame:
    """Rows of which the first one of each key stays; a key is kept in mind for ``delay``.

    State is bounded by the keys of that time. A row that comes later than that is dropped as late.
    A table, where nothing is late, gets one row per key.
    """
    if not events.isStreaming:
        return events.dropDuplicates(list(keys))
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def slot_counts(
    events: DataFrame, by: Sequence[str] = (), ts: str = "ts", slot: str = "1 hour", delay: str = "1 hour"
) -> DataFrame:
    """Rows per time slot, and per other columns: ``slot_start`` and ``rows``.

    On a stream a slot is given out once, when the watermark has passed its end; rows that come
    later than ``delay`` are not counted.
    """
    timed = events.withWatermark(ts, delay) if events.isStreaming else events
    counted = timed.groupBy(F.window(ts, slot).alias("slot"), *by).agg(F.count("*").alias("rows"))
    return counted.select(F.col("slot.start").alias("slot_start"), *by, "rows")
