"""Queries for joins and views."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ...model import BUSINESS_KEY, DAY
from ...operators import enrich
from ...session import work_path
from ...sources.results import read_table
from ..day_run import LEDGER, finished_rows, media_run, media_steps, queue_of, run_steps
from ..media import member_files, recorded
from . import derived
from .derived import EVENTS_SQL, MEDIA_SQL
from .registry import query, table

# The day a document is given: documents carry none.
_DAY_OF_DOC = "2024 AS year, CAST(doc_id % 12 + 1 AS INTEGER) AS month, CAST(doc_id % 28 + 1 AS INTEGER) AS day"


@query(f"""
WITH c AS (SELECT CAST(nullif(doc_id, 0) AS VARCHAR) AS meta_id, {_DAY_OF_DOC}, quality, toxic,
             'label' AS source FROM labels),
m AS (SELECT CAST(nullif(doc_id, 0) AS VARCHAR) AS meta_id, {_DAY_OF_DOC}, lang, source, n_chars
      FROM documents)
SELECT c.meta_id, c.year, c.month, c.day, c.quality, c.toxic, c.source AS source_x, m.lang,
  m.source AS source_y, m.n_chars
FROM c JOIN m ON c.meta_id IS NOT DISTINCT FROM m.meta_id
  AND c.year = m.year AND c.month = m.month AND c.day = m.day""")
def classified_join(spark, sf):
    key = F.nullif("doc_id", F.lit(0)).cast("string").alias("meta_id")
    day = [
        F.lit(2024).alias("year"),
        (F.col("doc_id") % 12 + 1).cast("int").alias("month"),
        (F.col("doc_id") % 28 + 1).cast("int").alias("day"),
    ]
    classified = table(spark, sf, "labels").select(
        key, *day, "quality", "toxic", F.lit("label").alias("source")
    )
    documents = table(spark, sf, "documents").select(key, *day, "lang", "source", "n_chars")
    return enrich.classified_join(classified, documents)


@query(f"""
WITH {MEDIA_SQL}
SELECT a.meta_id, a.year, a.month, a.date AS day, a.event_id, a.value, m.stats_playcount
FROM ev a JOIN m ON a.meta_id IS NOT DISTINCT FROM m.meta_id
  AND a.year = m.year AND a.month = m.month AND a.date = m.date""")
def salted_join(spark, sf):
    """Several classified rows per id; ids with more than three rows take the salted path."""
    classified = derived.keyed_events(spark, sf).withColumnRenamed("date", "day").select(
        "meta_id", "year", "month", "day", "event_id", "value"
    )
    metadata = derived.metadata(spark, sf).withColumnRenamed("date", "day").drop("meta_desc")
    return enrich.classified_join(classified, metadata, hot_rows=3)


@query(f"""
WITH {MEDIA_SQL},
c AS (SELECT meta_id, year, month, date, count(*) AS n FROM ev WHERE event_type = 'click' GROUP BY ALL),
s AS (SELECT meta_id, year, month, date, count(*) AS n FROM ev WHERE event_type = 'error' GROUP BY ALL)
SELECT m.meta_id, m.year, m.month, m.date, f.id AS audio_file_id, f.filename, f.file_path,
  f.file_size_bytes, t.transcript_text, t.word_count, t.duration_seconds, m.stats_playcount, m.meta_desc,
  coalesce(c.n, 0) AS comment_count, coalesce(s.n, 0) AS subtitle_count,
  f.id IS NOT NULL AS audio_file_processed, t.id IS NOT NULL AS transcript_processed
FROM m
LEFT JOIN f USING (meta_id, year, month, date)
LEFT JOIN t ON f.id = t.audio_file_id
LEFT JOIN c USING (meta_id, year, month, date)
LEFT JOIN s USING (meta_id, year, month, date)""")
def enriched_view(spark, sf):
    return enrich.enriched_view(
        derived.metadata(spark, sf),
        derived.files(spark, sf),
        derived.transcripts(spark, sf),
        derived.keyed_events(spark, sf, "click"),
        derived.keyed_events(spark, sf, "error"),
    )


@query(f"""
WITH {MEDIA_SQL}
SELECT f.id, f.meta_id, f.year, f.month, f.date, f.filename, f.file_path, f.file_size_bytes,
  t.transcript_text, t.word_count, t.duration_seconds, m.stats_playcount, m.meta_desc
FROM f LEFT JOIN t ON f.id = t.audio_file_id
LEFT JOIN m ON f.meta_id = m.meta_id AND f.year = m.year AND f.month = m.month AND f.date = m.date""")
def files_view(spark, sf):
    return enrich.files_with_metadata(
        derived.files(spark, sf), derived.transcripts(spark, sf), derived.metadata(spark, sf)
    )


@query(f"""
WITH {MEDIA_SQL}
SELECT f.year, f.month, f.date, count(*) AS transcripts
FROM t JOIN f ON t.audio_file_id = f.id GROUP BY ALL""")
def day_transcripts(spark, sf):
    joined = enrich.day_transcripts(derived.transcripts(spark, sf), derived.files(spark, sf))
    return joined.groupBy(*DAY).agg(F.count("*").alias("transcripts"))


@query(f"""
WITH {EVENTS_SQL}
SELECT meta_id, year, month, date, count(*) AS comments FROM ev GROUP BY ALL""")
def child_counts(spark, sf):
    return enrich.child_counts(derived.keyed_events(spark, sf), "comments")


@query(f"""
WITH {EVENTS_SQL},
d AS (SELECT 'e' || event_id AS meta_id, year, month, date, event_type, value,
    'audio/' || year || '/' || lpad(CAST(month AS VARCHAR), 2, '0') || '/' ||
    lpad(CAST(date AS VARCHAR), 2, '0') || '/' || strftime(ts, '%H_%M') || '/e' || event_id || '.opus' AS file_path
  FROM ev WHERE event_type <> 'error')
SELECT sha256(concat_ws('|', meta_id, year, month, date)) AS id, meta_id, year, month, date, file_path,
  event_type = 'purchase' AS has_transcript, CASE WHEN event_type = 'purchase' THEN value END AS duration_seconds
FROM d""")
def record_members(spark, sf):
    """Members of archives joined to their outcomes by name; failed members leave no rows."""
    members, outcomes = _members(spark, sf)
    has_transcript = F.col("transcript_text").isNotNull()
    return recorded(members, outcomes).select(
        "id", *BUSINESS_KEY, "file_path", has_transcript.alias("has_transcript"),
        F.when(has_transcript, F.col("duration_seconds")).alias("duration_seconds"),
    )


def _members(spark, sf):
    """File rows of members, one per event, and what became of them."""
    archive = F.concat(F.lit("0_"), F.date_format("ts", "yyyy-MM-dd_HH_mm"), F.lit(".tar.xz"))
    rows = table(spark, sf, "events").select(
        "event_type", "value", "event_id", archive.alias("archive"),
        F.format_string("e%d.mp3", "event_id").alias("member"),
    )
    members = member_files(rows.select("archive", "member", F.col("event_id").alias("size")))
    kind = F.col("event_type")
    outcomes = rows.select(
        "archive", F.col("member").alias("filename"),
        F.when(kind == "error", "conversion failed").alias("error"),
        F.when(kind == "purchase", F.lit("text")).alias("transcript_text"),
        F.lit(1).cast("long").alias("word_count"),
        F.col("value").alias("duration_seconds"),
    )
    return members, outcomes


@query("""
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS date,
  CASE WHEN count(*) FILTER (event_type = 'error') = 0 THEN 'completed'
    WHEN count(*) FILTER (event_type <> 'error') > 0 THEN 'completed_with_errors' ELSE 'processing_failed' END AS status,
  CASE WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'Failed files: ' || count(*) FILTER (event_type = 'error')
    || ', Processed: ' || count(*) FILTER (event_type <> 'error') END AS error_message,
  count(*) FILTER (event_type <> 'error') AS files, count(*) FILTER (event_type = 'purchase') AS transcripts, 4 AS steps
FROM events GROUP BY ALL""")
def day_run(spark, sf):
    """A media run of all days, taken up by a second run after a first one that ended between two steps."""
    members, outcomes = _members(spark, sf)
    days, root = members.select(*DAY).distinct(), work_path(spark, "day-run")
    first = media_steps(members, outcomes, root, "first", datetime(2024, 2, 1))
    run_steps(spark, days, first[:2], root, "first", datetime(2024, 2, 1))
    first[2][1](days)  # killed after the table was written and before the ledger knew
    media_run(spark, days, members, outcomes, root, "second", datetime(2024, 2, 2))
    count = lambda name, rows: rows.groupBy(*DAY).agg(F.count("*").alias(name))
    out = queue_of(spark, root).select(*DAY, "status", "error_message")
    for name, rows in [
        ("files", finished_rows(spark, root, "audio_files", "audio_files")),
        ("transcripts", finished_rows(spark, root, "transcripts", "transcripts")),
    ]:
        out = out.join(count(name, rows), DAY, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    ledger = read_table(spark, f"{root}/ledger", LEDGER).groupBy(*DAY).agg(F.count("*").cast("int").alias("steps"))
    return out.join(ledger, DAY, "left")
