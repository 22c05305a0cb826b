"""Queries for counts, outcomes and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import sql as sql_functions
from ...model import DAY
from ...operators import enrich, reports
from ...operators.keyed import keep_first
from ...operators.queue import day_outcome
from . import derived
from .derived import EVENTS_SQL, MEDIA_SQL, QUEUE_ROWS_SQL, sql_day_text, sql_stamp, stamp
from .registry import SQL, query, table


@query(f"""
WITH {QUEUE_ROWS_SQL}
SELECT status, count(*) AS count, min({sql_day_text()}) AS oldest, max({sql_day_text()}) AS newest
FROM qr GROUP BY status""")
def status_summary(spark, sf):
    return reports.status_summary(derived.queue_rows(spark, sf))


@query("""
WITH n AS (SELECT count(*) AS total, count(*) FILTER (WHERE toxic = 0) AS n0,
  count(*) FILTER (WHERE toxic = 1) AS n1 FROM labels)
SELECT CAST(0 AS INTEGER) AS classification, n0 AS count, round(100.0 * n0 / total, 1)::DOUBLE AS percent FROM n
UNION ALL SELECT 1, n1, round(100.0 * n1 / total, 1)::DOUBLE FROM n""")
def class_summary(spark, sf):
    return reports.class_summary(table(spark, sf, "labels"), "toxic")


# A day's first event stands for its queue row.
_FIRST_QUEUE = f"""
q AS (SELECT year, month, date,
    CASE WHEN event_id % 3 = 0 THEN 'completed' WHEN event_id % 3 = 1 THEN 'processing' END AS status,
    ts AS processing_start, CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 90 MINUTE END AS processing_end,
    CASE WHEN event_id % 5 = 0 THEN props END AS error_message
  FROM (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY year, month, date ORDER BY ts, event_id) = 1))"""


def first_queue(spark, sf):
    first = keep_first(derived.keyed_events(spark, sf), DAY, derived.EVENT_ORDER)
    third = F.col("event_id") % 3
    return first.select(
        *DAY,
        F.when(third == 0, "completed").when(third == 1, "processing").alias("status"),
        F.col("ts").alias("processing_start"),
        F.when(third == 0, F.col("ts") + F.expr("INTERVAL 90 MINUTES")).alias("processing_end"),
        F.when(F.col("event_id") % 5 == 0, F.col("props")).alias("error_message"),
    )


@query(f"""
WITH {MEDIA_SQL}, {_FIRST_QUEUE},
days AS (SELECT DISTINCT year, month, date FROM ev),
nf AS (SELECT year, month, date, count(*) AS n FROM f GROUP BY ALL),
nt AS (SELECT f.year, f.month, f.date, count(*) AS n FROM t JOIN f ON t.audio_file_id = f.id GROUP BY ALL),
nm AS (SELECT year, month, date, count(*) AS n FROM m GROUP BY ALL)
SELECT {sql_day_text("d.")} AS date, coalesce(nf.n, 0) AS audio_files, coalesce(nt.n, 0) AS transcripts,
  coalesce(nm.n, 0) AS metadata_records,
  CASE WHEN q.year IS NULL THEN 'not_found' ELSE q.status END AS queue_status,
  {sql_stamp("q.processing_start")} AS processing_start, {sql_stamp("q.processing_end")} AS processing_end,
  q.error_message
FROM days d LEFT JOIN nf USING (year, month, date) LEFT JOIN nt USING (year, month, date)
LEFT JOIN nm USING (year, month, date) LEFT JOIN q USING (year, month, date)""")
def day_statistics(spark, sf):
    files = derived.files(spark, sf)
    out = reports.day_statistics(
        files,
        enrich.day_transcripts(derived.transcripts(spark, sf), files),
        derived.metadata(spark, sf),
        first_queue(spark, sf),
    )
    return out.withColumns({c: stamp(c) for c in ("processing_start", "processing_end")})


_STATES = {
    ("A", "F"): "COMPLETED", ("R", "F"): "FAILED", ("N", "F"): "TIMEOUT",
    ("A", "O"): "RUNNING", ("R", "O"): "PENDING", ("N", "O"): "SUSPENDED",
}


@query(f"""
WITH w AS (SELECT l_orderkey AS master_job_id, CASE {' '.join(
    f"WHEN l_returnflag = '{a}' AND l_linestatus = '{b}' THEN '{s}'" for (a, b), s in _STATES.items())} END AS state
  FROM lineitem),
r AS (SELECT master_job_id, count(*) AS workers,
    count(*) FILTER (WHERE state = 'COMPLETED') AS completed,
    count(*) FILTER (WHERE state IN ('FAILED', 'CANCELLED', 'TIMEOUT', 'NODE_FAIL')) AS failed,
    count(*) FILTER (WHERE state IN ('RUNNING', 'PENDING', 'CONFIGURING')) AS running FROM w GROUP BY 1)
SELECT *, completed + failed AS finished,
  CASE WHEN workers = 0 OR running > 0 THEN 'processing_failed' WHEN failed = 0 THEN 'completed'
    ELSE 'completed_with_errors' END AS status,
  CASE WHEN running > 0 THEN 'Worker jobs timed out' WHEN failed > 0 THEN failed || ' worker jobs failed' END
    AS error_message
FROM r""")
def worker_rollup(spark, sf):
    """Workers of each job; a job with workers still running counts as timed out."""
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    state = F.lit(None).cast("string")
    for (a, b), name in _STATES.items():
        state = F.when((flag == a) & (line == b), name).otherwise(state)
    workers = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("master_job_id"), state.alias("state")
    )
    return day_outcome(reports.worker_rollup(workers), timed_out=F.col("running") > 0)


@query("""
SELECT l_orderkey AS master_job_id, count(*) AS archives, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT)
  AS files_processed, CAST(sum(l_linenumber) AS BIGINT) AS files_failed FROM lineitem GROUP BY 1""")
def master_progress(spark, sf):
    return reports.master_progress(table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("master_job_id"),
        F.col("l_quantity").cast("int").alias("files_processed"),
        F.col("l_linenumber").alias("files_failed"),
    ))


@query(SQL["master_progress"])
def progress_sql(spark, sf):
    """The same sums by the table function that SQL text can call."""
    table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS master_job_id", "CAST(l_quantity AS INT) AS files_processed", "l_linenumber AS files_failed",
    ).createOrReplaceTempView(sql_functions.TRACKING)
    sql_functions.register_progress(spark)
    return spark.sql(
        f"SELECT m AS master_job_id, p.* FROM (SELECT DISTINCT master_job_id AS m FROM {sql_functions.TRACKING}), "
        "LATERAL parallel_progress(m) p")


_OUTCOMES = """
o AS (SELECT l_orderkey AS archive, count(*) AS total, count(*) FILTER (WHERE l_returnflag <> 'R') AS succeeded,
  count(*) FILTER (WHERE l_returnflag = 'R') AS failed FROM lineitem GROUP BY 1)"""


def _outcomes(spark, sf):
    members = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("archive"), "l_returnflag")
    return reports.archive_outcomes(members, "archive", F.col("l_returnflag") != "R")


@query(f"WITH {_OUTCOMES} SELECT *, failed > 0 AS archive_failed FROM o")
def archive_outcomes(spark, sf):
    return _outcomes(spark, sf)


@query(f"""
WITH {_OUTCOMES}
SELECT count(*) FILTER (WHERE failed = 0) AS archives_processed,
  count(*) FILTER (WHERE failed > 0) AS archives_failed,
  CAST(sum(succeeded) AS BIGINT) AS files_converted, CAST(sum(failed) AS BIGINT) AS files_failed FROM o""")
def archive_totals(spark, sf):
    return reports.archive_totals(_outcomes(spark, sf))


@query("""
WITH o AS (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag <> 'R') AS processed_count,
  count(*) FILTER (WHERE l_returnflag = 'R') AS failed_count FROM lineitem GROUP BY 1)
SELECT *, CASE WHEN failed_count = 0 THEN 'completed'
    WHEN failed_count > 0 AND processed_count > 0 THEN 'completed_with_errors'
    ELSE 'processing_failed' END AS status,
  CASE WHEN failed_count > 0 THEN 'Failed files: ' || failed_count || ', Processed: ' || processed_count END
    AS error_message
FROM o""")
def final_status(spark, sf):
    rows = table(spark, sf, "lineitem")
    return reports.with_final_status(
        reports.batch_outcome(rows, ["l_orderkey"], F.col("l_returnflag") != "R")
    )


@query(f"""
WITH {EVENTS_SQL}
SELECT strftime(ts, '0_%Y-%m-%d_%H_00_') || event_type || '.parquet' AS source_filename, count(*) AS rows
FROM ev GROUP BY 1""")
def rows_per_file(spark, sf):
    name = F.concat(
        F.lit("0_"), F.date_format("ts", "yyyy-MM-dd_HH"), F.lit("_00_"), F.col("event_type"), F.lit(".parquet")
    )
    return reports.rows_per_file(table(spark, sf, "events").select(name.alias("source_filename")))


@query(f"""
WITH {EVENTS_SQL},
x AS (SELECT year, month, date, count(*) AS expected,
  count(*) FILTER (WHERE value >= 5) AS arrived FROM ev GROUP BY ALL)
SELECT *, expected * 90 // 100 AS needed,
  CASE WHEN arrived >= expected * 90 // 100 THEN 'ready_to_process' ELSE 'transfer_failed' END AS status FROM x""")
def completeness_gate(spark, sf):
    rows = derived.keyed_events(spark, sf)
    expected = rows.groupBy(*DAY).agg(F.count("*").alias("expected"))
    return reports.completeness_gate(expected, rows.filter(F.col("value") >= 5))


@query("""
SELECT conv_id, string_agg(trim(text), ' ' ORDER BY turn) AS transcript_text,
  CAST(sum(len(list_filter(regexp_split_to_array(text, '[\\s\\x{85}\\p{Z}]+'), lambda w: w <> ''))) AS BIGINT)
    AS word_count,
  count(*) AS segments, round(sum(length(text) * 160) / 16000.0, 6) AS duration_seconds
FROM conversations GROUP BY conv_id""")
def transcript_assembly(spark, sf):
    segments = table(spark, sf, "conversations").withColumn("samples", F.length("text") * 160)
    out = reports.assemble_transcripts(segments, ["conv_id"], "turn", "text", "samples")
    return out.withColumn("duration_seconds", F.round("duration_seconds", 6))


@query("""
WITH r AS (SELECT conv_id, role, min(turn) AS first FROM conversations GROUP BY ALL)
SELECT conv_id, string_agg(role, ', ' ORDER BY first, role) AS roles FROM r GROUP BY conv_id""")
def ordered_labels(spark, sf):
    return reports.ordered_labels(table(spark, sf, "conversations"), ["conv_id"], "role", "turn", "roles")


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]
_WIDTHS = [2, 3, 5, 4, 6, 6, 11, 6, 5, 3, 3, 2, 3, 4]


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, CAST({w} AS INTEGER) AS columns FROM {t}"
    for t, w in zip(TABLES, _WIDTHS)
))
def table_profile(spark, sf):
    return reports.table_profile({t: table(spark, sf, t) for t in TABLES})


@query("""
SELECT max(o_orderpriority) AS max_version,
  arg_max(o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') || o_orderpriority) AS last_version FROM orders""")
def latest_version(spark, sf):
    versions = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("version"), F.col("o_orderdate").alias("applied_at")
    )
    return reports.latest_version(versions)


@query("""
WITH d AS (SELECT CASE WHEN doc_id % 14 = 0 THEN NULL WHEN doc_id % 9 = 0 THEN chr(160) || chr(9) ELSE text END AS t
  FROM documents)
SELECT count(*) AS total, count(*) FILTER (WHERE t IS NULL) AS missing,
  count(*) FILTER (WHERE t IS NULL OR NOT regexp_matches(t, '[^\\s\\x{85}\\p{Z}\\x1c-\\x1f]')) AS blank FROM d""")
def missing_text(spark, sf):
    doc = F.col("doc_id")
    text = F.when(doc % 14 != 0, F.when(doc % 9 == 0, F.lit("\u00a0\t")).otherwise(F.col("text")))
    return reports.missing_text(table(spark, sf, "documents").select(text.alias("t")), "t")
