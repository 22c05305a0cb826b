"""Queries for dedup, upsert, inserts, deletes and resume."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ...functions import surrogate_id
from ...model import BUSINESS_KEY, DAY
from ...operators import keyed
from . import derived
from .derived import EVENTS_SQL, QUEUE_ROWS_SQL, sql_stamp, stamp
from .registry import query, table

FIRST_RUN = dt.datetime(2024, 2, 1)
SECOND_RUN = dt.datetime(2024, 2, 2)


@query(f"""
WITH {EVENTS_SQL}
SELECT meta_id, year, month, date, event_id, {sql_stamp("ts")} AS ts, event_type, value, props FROM ev
QUALIFY row_number() OVER (PARTITION BY meta_id, year, month, date ORDER BY ts DESC, event_id DESC) = 1""")
def keep_last_by_key(spark, sf):
    rows = derived.keyed_events(spark, sf)
    kept = keyed.keep_last(rows, BUSINESS_KEY, derived.EVENT_ORDER)
    return kept.select(*BUSINESS_KEY, "event_id", stamp("ts").alias("ts"), "event_type", "value", "props")


@query(f"""
WITH {EVENTS_SQL}, k AS (SELECT meta_id, year, month, date, count(*) AS n FROM ev GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after,
  CAST(sum(n) - count(*) AS BIGINT) AS rows_removed FROM k""")
def dedup_report(spark, sf):
    return keyed.dedup_report(derived.keyed_events(spark, sf), BUSINESS_KEY)


_HALF = f"""
  SELECT * FROM ev WHERE {{half}}
  QUALIFY row_number() OVER (PARTITION BY meta_id, year, month, date ORDER BY ts DESC, event_id DESC) = 1"""


@query(f"""
WITH {EVENTS_SQL},
t AS ({_HALF.format(half="hour(ts) < 12")}),
b AS ({_HALF.format(half="hour(ts) >= 12")})
SELECT sha256(concat_ws('|', coalesce(t.meta_id, b.meta_id), coalesce(t.year, b.year),
    coalesce(t.month, b.month), coalesce(t.date, b.date))) AS id,
  coalesce(t.meta_id, b.meta_id) AS meta_id, coalesce(t.year, b.year) AS year,
  coalesce(t.month, b.month) AS month, coalesce(t.date, b.date) AS date,
  CASE WHEN b.meta_id IS NOT NULL THEN b.event_type ELSE t.event_type END AS event_type,
  CASE WHEN b.meta_id IS NOT NULL THEN CASE WHEN b.event_id % 4 <> 0 THEN b.value END ELSE t.value END AS value,
  CASE WHEN t.meta_id IS NOT NULL THEN t.props ELSE '{{}}' END AS props,
  CASE WHEN t.meta_id IS NOT NULL THEN '{FIRST_RUN:%Y-%m-%d %H:%M:%S}.000000'
    ELSE '{SECOND_RUN:%Y-%m-%d %H:%M:%S}.000000' END AS created_at,
  CASE WHEN b.meta_id IS NOT NULL THEN '{SECOND_RUN:%Y-%m-%d %H:%M:%S}.000000'
    ELSE '{FIRST_RUN:%Y-%m-%d %H:%M:%S}.000000' END AS updated_at
FROM t FULL JOIN b ON t.meta_id = b.meta_id AND t.year = b.year AND t.month = b.month AND t.date = b.date""")
def upsert_partial(spark, sf):
    rows = derived.keyed_events(spark, sf)
    morning = keyed.keep_last(rows.filter(F.hour("ts") < 12), BUSINESS_KEY, derived.EVENT_ORDER)
    evening = keyed.keep_last(rows.filter(F.hour("ts") >= 12), BUSINESS_KEY, derived.EVENT_ORDER)
    first = F.lit(FIRST_RUN).cast("timestamp_ntz")
    target = morning.select(
        surrogate_id(*BUSINESS_KEY).alias("id"), *BUSINESS_KEY, "event_type", "value", "props",
        first.alias("created_at"), first.alias("updated_at"),
    )
    batch = evening.select(
        *BUSINESS_KEY, "event_type", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value")
    )
    second = F.lit(SECOND_RUN).cast("timestamp_ntz")
    out = keyed.upsert(target, batch, BUSINESS_KEY, second, {"props": "{}"})
    return out.withColumns({"created_at": stamp("created_at"), "updated_at": stamp("updated_at")})


@query(f"""
WITH {QUEUE_ROWS_SQL},
t AS (SELECT year, month, date, location, status FROM qr WHERE status = 'completed'
      QUALIFY row_number() OVER (PARTITION BY year, month, date ORDER BY o_orderkey) = 1),
b AS (SELECT year, month, date, location FROM qr WHERE status <> 'completed'
      QUALIFY row_number() OVER (PARTITION BY year, month, date ORDER BY o_orderkey) = 1)
SELECT * FROM t UNION ALL
SELECT *, 'pending' AS status FROM b WHERE NOT EXISTS (
  SELECT 1 FROM t WHERE t.year = b.year AND t.month = b.month AND t.date = b.date)""")
def insert_absent_first(spark, sf):
    rows = derived.queue_rows(spark, sf)
    target = keyed.keep_first(rows.filter("status = 'completed'"), DAY, ["o_orderkey"])
    batch = rows.filter("status <> 'completed'").select(*DAY, "location", "o_orderkey")
    target = target.select(*DAY, "location", "status")
    return keyed.insert_absent(target, batch, DAY, ["o_orderkey"], {"status": "pending"})


@query(f"""
WITH {QUEUE_ROWS_SQL},
t AS (SELECT DISTINCT year, month, date, location FROM qr WHERE status = 'completed')
SELECT o_orderkey, year, month, date, location, EXISTS (
  SELECT 1 FROM t WHERE t.year = qr.year AND t.month = qr.month AND t.date = qr.date
    AND t.location = qr.location) AS skipped
FROM qr WHERE status <> 'completed'""")
def skip_existing_entries(spark, sf):
    rows = derived.queue_rows(spark, sf).select("o_orderkey", *DAY, "location", "status")
    there = rows.filter("status = 'completed'")
    batch = rows.filter("status <> 'completed'").drop("status")
    fresh, skipped = keyed.skip_existing(there, batch, [*DAY, "location"])
    return fresh.withColumn("skipped", F.lit(False)).unionByName(skipped.withColumn("skipped", F.lit(True)))


@query("""
SELECT 'orders' AS table_name, o_orderkey AS order_key, CAST(NULL AS INTEGER) AS line
FROM orders WHERE o_orderstatus <> 'P'
UNION ALL
SELECT 'lineitem', l_orderkey, l_linenumber FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def cascade_delete(spark, sf):
    parents, children = keyed.delete_cascade(
        table(spark, sf, "orders"), table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey",
        F.col("o_orderstatus") == "P",
    )
    return parents.select(
        F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("order_key"),
        F.lit(None).cast("int").alias("line"),
    ).unionByName(children.select(
        F.lit("lineitem").alias("table_name"), F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
    ))


@query("""
SELECT o_orderkey, o_orderstatus FROM orders
WHERE NOT coalesce(nullif(o_orderstatus, 'O') = 'F' AND o_totalprice > 100000, false)""")
def delete_by_predicate(spark, sf):
    gone = (F.nullif("o_orderstatus", F.lit("O")) == "F") & (F.col("o_totalprice") > 100000)
    return keyed.delete_where(table(spark, sf, "orders"), gone).select("o_orderkey", "o_orderstatus")


@query("""
SELECT doc_id, lang, source FROM documents
WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)""")
def pending_resume(spark, sf):
    return keyed.pending(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "lang", "source"
    )


@query("""
SELECT doc_id, source || '/' || doc_id || '.opus' AS output_path FROM documents
WHERE source || '/' || doc_id || '.opus' NOT IN (
  SELECT d.source || '/' || d.doc_id || '.opus' FROM documents d JOIN labels USING (doc_id))""")
def pending_outputs(spark, sf):
    from ..media import to_convert

    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".opus"))
    docs = table(spark, sf, "documents").select("doc_id", path.alias("output_path"))
    there = docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id")
    return to_convert(docs, there).select("doc_id", "output_path")
