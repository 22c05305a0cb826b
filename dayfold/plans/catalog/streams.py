"""Queries that run a stream to its end and read what it left."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ...model import BUSINESS_KEY, KINDS
from ...session import work_path
from ...sources.results import read_table
from ...streaming.events import slot_counts, without_duplicates
from ...streaming.ingest import ingest_stream
from ...streaming.status import current_status, status_stream
from . import derived
from .derived import (
    DROP_TYPES, EVENTS_SQL, STATUS_FOLD_COLUMNS, STATUS_FOLD_SQL, sql_kept, sql_stamp, sql_types, stamp,
)
from .registry import query, table

NOW = dt.datetime(2024, 2, 1)


@query(f"""
WITH {EVENTS_SQL}
SELECT 'metadata' AS kind, meta_id, year, month, date, CAST(NULL AS VARCHAR) AS cid, props AS content
FROM ({sql_kept(*DROP_TYPES["metadata"])})
UNION ALL SELECT 'comments', meta_id, year, month, date, CAST(event_id AS VARCHAR), props
FROM ev WHERE {sql_types(*DROP_TYPES["comments"])}
UNION ALL SELECT 'subtitles', meta_id, year, month, date, NULL, props FROM ({sql_kept(*DROP_TYPES["subtitles"])})""")
def stream_ingest(spark, sf):
    """All events as drops, each kind taken up by its stream in several micro-batches."""
    root = work_path(spark, "stream-in")
    derived.write_event_drops(spark, sf, root)
    parts = []
    for kind, text in (("metadata", "meta_desc"), ("comments", "comment_text"), ("subtitles", "content")):
        out, checkpoint = (work_path(spark, f"stream-{x}") for x in ("table", "state"))
        ingest_stream(spark, root, kind, out, checkpoint, lambda: NOW, files_per_batch=100).awaitTermination()
        stored = read_table(spark, out, KINDS[kind].table_schema)
        cid = F.col("cid") if kind == "comments" else F.lit(None).cast("string")
        parts.append(stored.select(F.lit(kind).alias("kind"), *BUSINESS_KEY, cid.alias("cid"), F.col(text).alias("content")))
    return reduce(DataFrame.unionByName, parts)


def _events_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _run(frame, spark, label: str, schema):
    """Run a stream to its end and read what it gave out."""
    out, checkpoint = (work_path(spark, f"{label}-{x}") for x in ("table", "state"))
    stream = frame.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(schema).parquet(out)


@query(f"""
WITH c AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS slot, event_type, count(*) AS rows FROM events GROUP BY ALL)
SELECT {sql_stamp("slot")} AS slot_start, event_type, rows FROM c
WHERE slot + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_slot_counts(spark, sf):
    """Events per hour and type, of all hours that are over for good when the stream ends."""
    events = _events_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = slot_counts(events, ["event_type"])
    found = _run(counts, spark, "slots", counts.schema)
    return found.withColumn("slot_start", stamp(F.col("slot_start")))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct(spark, sf):
    """One event per user and type, told within a delay that spans all events."""
    events = _events_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    kept = without_duplicates(events, ["user_id", "event_type"], delay="100 days")
    return _run(kept, spark, "distinct", kept.schema).select("user_id", "event_type")


@query(STATUS_FOLD_SQL)
def stream_status(spark, sf):
    out, checkpoint = (work_path(spark, f"status-{x}") for x in ("table", "state"))
    stream = status_stream(
        derived.status_events(_events_stream(spark, sf)), out, checkpoint, ["user_id"], "ts", "event_id"
    )
    stream.awaitTermination()
    state = current_status(spark, out, ["user_id"])
    return state.withColumns({c: stamp(F.col(c)) for c in STATUS_FOLD_COLUMNS})
