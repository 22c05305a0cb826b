"""Stand-ins for the domain's tables, derived from the supplied ones, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ...functions import day_text, storage_path, surrogate_id
from ...model import BUSINESS_KEY, DAY
from ...operators.keyed import keep_first, keep_last
from ...sources.drops import open_file
from .registry import table

EVENT_ORDER = ["ts", "event_id"]
VALUE_LIMIT = 20.0


def stamp(moment: str | Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sql_stamp(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S.%f')"


def with_day(df: DataFrame, moment: str) -> DataFrame:
    return df.withColumns({
        "year": F.year(moment), "month": F.month(moment), "date": F.dayofmonth(moment),
    })


def sql_day(moment: str) -> str:
    return (
        f"CAST(year({moment}) AS INTEGER) AS year, CAST(month({moment}) AS INTEGER) AS month, "
        f"CAST(day({moment}) AS INTEGER) AS date"
    )


def sql_day_text(prefix: str = "") -> str:
    return (
        f"({prefix}year || '-' || lpad(CAST({prefix}month AS VARCHAR), 2, '0') || '-' || "
        f"lpad(CAST({prefix}date AS VARCHAR), 2, '0'))"
    )


# --- events as metadata, comments, subtitles, files and transcripts ---

# The event types that stand for metadata and for each kind of drop; files are made of all events.
METADATA = ("view", "signup")
DROP_TYPES = {"metadata": METADATA, "comments": ("click", "purchase"), "subtitles": ("error",)}


def keyed_events(spark: SparkSession, sf: str, *types: str) -> DataFrame:
    events = table(spark, sf, "events")
    if types:
        events = events.filter(F.col("event_type").isin(list(types)))
    return with_day(events, "ts").withColumn("meta_id", F.col("user_id").cast("string"))


def kept_events(spark: SparkSession, sf: str, *types: str) -> DataFrame:
    return keep_last(keyed_events(spark, sf, *types), BUSINESS_KEY, EVENT_ORDER)


def metadata(spark: SparkSession, sf: str) -> DataFrame:
    return kept_events(spark, sf, *METADATA).select(
        *BUSINESS_KEY, F.col("props").alias("meta_desc"), F.col("event_id").alias("stats_playcount")
    )


def files(spark: SparkSession, sf: str) -> DataFrame:
    name = F.format_string("e%d.opus", "event_id")
    return kept_events(spark, sf).select(
        surrogate_id(*BUSINESS_KEY).alias("id"), *BUSINESS_KEY,
        F.format_string("e%d.mp3", "event_id").alias("filename"),
        storage_path(*DAY, F.date_format("ts", "HH_mm"), name).alias("file_path"),
        F.col("event_id").alias("file_size_bytes"),
        "value", "props",
    )


def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return files(spark, sf).filter(F.col("value") > VALUE_LIMIT).select(
        surrogate_id(F.lit("transcript"), "id").alias("id"),
        F.col("id").alias("audio_file_id"),
        F.col("props").alias("transcript_text"),
        F.size(F.split("props", " ")).cast("long").alias("word_count"),
        F.col("value").alias("duration_seconds"),
    )


def sql_types(*types: str) -> str:
    return f"event_type IN ({', '.join(f"'{t}'" for t in types)})" if types else "true"


def sql_kept(*types: str) -> str:
    return f"""
  SELECT * FROM ev WHERE {sql_types(*types)}
  QUALIFY row_number() OVER (
    PARTITION BY meta_id, year, month, date ORDER BY ts DESC, event_id DESC) = 1"""


EVENTS_SQL = f"""
ev AS (SELECT *, CAST(user_id AS VARCHAR) AS meta_id, {sql_day("ts")} FROM events)"""

MEDIA_SQL = f"""{EVENTS_SQL},
m AS (SELECT meta_id, year, month, date, props AS meta_desc, event_id AS stats_playcount
      FROM ({sql_kept(*METADATA)})),
f AS (SELECT sha256(meta_id || '|' || year || '|' || month || '|' || date) AS id,
        meta_id, year, month, date, 'e' || event_id || '.mp3' AS filename,
        'audio/' || year || '/' || lpad(CAST(month AS VARCHAR), 2, '0') || '/' ||
        lpad(CAST(date AS VARCHAR), 2, '0') || '/' || strftime(ts, '%H_%M') || '/e' || event_id || '.opus'
          AS file_path,
        event_id AS file_size_bytes, value, props
      FROM ({sql_kept()})),
t AS (SELECT sha256('transcript|' || id) AS id, id AS audio_file_id, props AS transcript_text,
        CAST(len(string_split(props, ' ')) AS BIGINT) AS word_count, value AS duration_seconds
      FROM f WHERE value > {VALUE_LIMIT})"""


# --- orders as the processing queue ---

STATUS_OF_ORDER = {"F": "completed", "O": "pending", "P": "processing"}


def queue_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A queue row per order: several per day."""
    status = F.col("o_orderstatus")
    start = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)")
    )
    end = start + F.make_dt_interval(secs=(F.col("o_custkey") * 37 % 200000).cast("decimal(18,6)"))
    return with_day(table(spark, sf, "orders"), "o_orderdate").select(
        *DAY,
        F.col("o_orderpriority").alias("location"),
        F.when(status == "F", "completed").when(status == "O", "pending").otherwise("processing").alias("status"),
        start.alias("processing_start"),
        F.when(F.col("o_orderpriority") != "1-URGENT", end).alias("processing_end"),
        F.lit(None).cast("string").alias("error_message"),
        "o_orderkey",
    )


def queue(spark: SparkSession, sf: str) -> DataFrame:
    """A queue row per day: that of the day's first order."""
    return keep_first(queue_rows(spark, sf), DAY, ["o_orderkey"])


QUEUE_ROWS_SQL = f"""
qr AS (SELECT {sql_day("o_orderdate")}, o_orderpriority AS location,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'processing' END AS status,
    CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS processing_start,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN
      CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) + to_seconds(o_custkey * 37 % 200000)
    END AS processing_end,
    CAST(NULL AS VARCHAR) AS error_message, o_orderkey
  FROM orders)"""

QUEUE_SQL = f"""{QUEUE_ROWS_SQL},
q AS (SELECT * FROM qr
      QUALIFY row_number() OVER (PARTITION BY year, month, date ORDER BY o_orderkey) = 1)"""


# --- events as status events of the day named by user_id ---

STATUS_OF_EVENT = {
    "view": "pending", "signup": "transferring", "click": "ready_to_process",
    "error": "processing", "purchase": "completed",
}


def status_events(events: DataFrame) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in STATUS_OF_EVENT.items() for x in pair])
    kind = F.col("event_type")
    return events.select(
        "user_id", "ts", "event_id",
        F.element_at(names, kind).alias("status"),
        F.when(kind == "signup", F.col("event_id").cast("string")).alias("transfer_task_id"),
        F.when(kind == "error", F.col("event_id")).alias("job_id"),
        F.when((kind == "purchase") & (F.col("value") > 50), F.col("props")).alias("error_message"),
    )


STATUS_FOLD_COLUMNS = ["transfer_start", "transfer_end", "processing_start", "processing_end"]
STATUS_FOLD_SQL = f"""
WITH e AS (SELECT *, CASE event_type {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in STATUS_OF_EVENT.items())} END AS status,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
SELECT user_id, arg_max(status, rn) AS status,
  {sql_stamp("max(CASE WHEN status = 'transferring' THEN ts END)")} AS transfer_start,
  {sql_stamp("max(CASE WHEN status = 'ready_to_process' THEN ts END)")} AS transfer_end,
  {sql_stamp("max(CASE WHEN status = 'processing' THEN ts END)")} AS processing_start,
  {sql_stamp("max(CASE WHEN status = 'completed' THEN ts END)")} AS processing_end,
  arg_max(CAST(event_id AS VARCHAR), rn) FILTER (WHERE event_type = 'signup') AS transfer_task_id,
  arg_max(event_id, rn) FILTER (WHERE event_type = 'error') AS job_id,
  arg_max(props, rn) FILTER (WHERE event_type = 'purchase' AND value > 50) AS error_message
FROM e GROUP BY user_id"""


# --- events as dated drop files ---

def write_drops(df: DataFrame, root: str) -> None:
    """Write rows as drop files ``<task>-<part>_<slot>_<kind>.parquet`` from within tasks.

    Rows carry ``kind`` and ``slot`` and the columns of all kinds. Each Arrow batch is cut by kind
    and slot, and a file gets the columns of its kind. Whole-number columns with gaps become
    floating point and empty ones lose their type, as pandas writes them, so types drift.
    Give rows sorted by time: file names then sort by time as well.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        system, folder = open_file(root)
        system.create_dir(folder, recursive=True)
        for part, frame in enumerate(frames):
            for (kind, slot), rows in frame.groupby(["kind", "slot"], sort=True):
                own = [c for c in rows.columns if c.startswith(f"{kind}__")]
                drop = rows[own].rename(columns={c: c.split("__", 1)[1] for c in own})
                name = f"{folder}/{task:05d}-{part:06d}_{slot}_{kind}.parquet"
                with system.open_output_stream(name) as out:
                    pq.write_table(pa.Table.from_pandas(drop, preserve_index=False), out)
                yield pd.DataFrame({"rows": [len(drop)]})

    # foreach-like: the write happens in the tasks, only a sum comes back
    df.mapInPandas(run, "rows long").agg(F.sum("rows")).collect()


def write_event_drops(spark: SparkSession, sf: str, root: str, *kinds: str) -> None:
    """All events as metadata, comment and subtitle drops, one slot per day."""
    kind = F.lit(None)
    for name, types in DROP_TYPES.items():
        kind = F.when(F.col("event_type").isin(*types), name).otherwise(kind)
    third = F.col("event_id") % 3
    flag = F.when(third == 0, F.lit(None)).otherwise(third - 1).cast("double")
    rows = keyed_events(spark, sf).withColumn("kind", kind)
    if kinds:
        rows = rows.filter(F.col("kind").isin(list(kinds)))
    rows = rows.select(
        "kind", "ts", "event_id",
        F.concat(day_text(*DAY), F.lit("_00_00")).alias("slot"),
        F.col("meta_id").alias("metadata__meta_id"),
        F.col("props").alias("metadata__meta_desc"),
        F.col("event_id").alias("metadata__stats_playcount"),
        flag.alias("metadata__meta_secret"),
        F.col("meta_id").alias("comments__meta_id"),
        F.col("event_id").cast("string").alias("comments__cid"),
        F.col("props").alias("comments__text"),
        flag.alias("comments__author_pin"),
        F.col("meta_id").alias("subtitles__meta_id"),
        F.col("props").alias("subtitles__content"),
        F.when(F.col("value") > VALUE_LIMIT, "en").alias("subtitles__lang"),
    )
    write_drops(rows.repartitionByRange(*EVENT_ORDER).sortWithinPartitions(*EVENT_ORDER), root)
