"""Queries for column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import (
    argmax_index, extension_swapped, file_day, file_month, file_year, fill_template, flag,
    folder_name, has_file_date, is_day_text, nonblank, parse_folder, slot_of_archive, softmax,
    storage_path,
)
from ...functions import sql as sql_functions
from ...model import ARCHIVES_PER_TASK, KINDS
from ...operators.ranking import with_chunks
from ...sources.drops import prepare
from .registry import query, table

_NAME = """CASE WHEN event_id % 50 = 0 THEN 'undated_' || event_id || '.tar.xz'
    ELSE '0_' || strftime(ts, '%Y-%m-%d_%H_%M') || '.tar.xz' END"""


@query(f"""
WITH n AS (SELECT event_id, {_NAME} AS name, 'media/m' || event_id || '.mp3' AS member FROM events),
p AS (SELECT *, TRY_CAST(regexp_extract(name, '(\\d{{4}})-(\\d{{2}})-(\\d{{2}})', 1) AS INTEGER) AS year,
  TRY_CAST(regexp_extract(name, '(\\d{{4}})-(\\d{{2}})-(\\d{{2}})', 2) AS INTEGER) AS month,
  TRY_CAST(regexp_extract(name, '(\\d{{4}})-(\\d{{2}})-(\\d{{2}})', 3) AS INTEGER) AS date,
  nullif(regexp_extract(name, '0_\\d{{4}}-\\d{{2}}-\\d{{2}}_(\\d{{2}}_\\d{{2}})\\.tar\\.xz', 1), '') AS slot FROM n)
SELECT event_id, year IS NOT NULL AS dated, year, month, date, slot,
  regexp_matches(substr(name, 3, 10), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AS is_day,
  replace(name, '.tar.xz', '') || '/m' || event_id || '.opus' AS output_path,
  CASE WHEN year IS NOT NULL THEN 'audio/' || year || '/' || lpad(CAST(month AS VARCHAR), 2, '0') || '/' ||
    lpad(CAST(date AS VARCHAR), 2, '0') || '/' || slot || '/m' || event_id || '.opus' END AS storage_path
FROM p""")
def file_name_fields(spark, sf):
    name = F.when(
        F.col("event_id") % 50 == 0, F.format_string("undated_%d.tar.xz", "event_id")
    ).otherwise(F.concat(F.lit("0_"), F.date_format("ts", "yyyy-MM-dd_HH_mm"), F.lit(".tar.xz")))
    names = table(spark, sf, "events").select(
        "event_id", name.alias("name"), F.format_string("media/m%d.mp3", "event_id").alias("member")
    )
    path = storage_path(
        file_year("name"), file_month("name"), file_day("name"), slot_of_archive("name"),
        F.format_string("m%d.opus", "event_id"),
    )
    return names.select(
        "event_id",
        has_file_date("name").alias("dated"),
        file_year("name").alias("year"), file_month("name").alias("month"), file_day("name").alias("date"),
        slot_of_archive("name").alias("slot"),
        is_day_text(F.substring("name", 3, 10)).alias("is_day"),
        extension_swapped("name", "member").alias("output_path"),
        F.when(has_file_date("name"), path).alias("storage_path"),
    )


@query("""
WITH o AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'Basel' ELSE 'zurich' END || '_' || year(o_orderdate) || '_' ||
    CASE WHEN o_orderkey % 11 = 0 THEN 'smarch' ELSE lower(monthname(o_orderdate)) END AS folder FROM orders),
g AS (SELECT folder, count(*) AS n FROM o GROUP BY 1),
p AS (SELECT *, regexp_matches(folder, '^([a-z]+)_([0-9]{4})_([a-z]+)$') AS fits,
  list_position(['january','february','march','april','may','june','july','august','september','october','november','december'],
    regexp_extract(folder, '^([a-z]+)_([0-9]{4})_([a-z]+)$', 3)) AS m FROM g)
SELECT folder, n, CASE WHEN fits AND m > 0 THEN regexp_extract(folder, '^([a-z]+)_', 1) END AS location,
  CASE WHEN fits AND m > 0 THEN CAST(regexp_extract(folder, '_([0-9]{4})_', 1) AS INTEGER) END AS year,
  CASE WHEN fits AND m > 0 THEN CAST(m AS INTEGER) END AS month,
  CASE WHEN fits AND m > 0 THEN regexp_extract(folder, '_([0-9]{4})_', 1) || '-' ||
    lpad(CAST(m AS VARCHAR), 2, '0') || '-01' END AS day_text,
  CASE WHEN NOT fits THEN 'shape' WHEN coalesce(m, 0) = 0 THEN 'month' END AS error
FROM p""")
def folder_names(spark, sf):
    key = F.col("o_orderkey")
    good = folder_name(
        F.when(key % 7 == 0, "Basel").otherwise("zurich"), F.year("o_orderdate"), F.month("o_orderdate")
    )
    folder = F.when(key % 11 == 0, F.regexp_replace(good, "[a-z]+$", "smarch")).otherwise(good)
    counted = table(spark, sf, "orders").groupBy(folder.alias("folder")).agg(F.count("*").alias("n"))
    return counted.select("folder", "n", F.inline(F.array(parse_folder("folder"))))


@query("""
SELECT 'zurich_' || year(o_orderdate) || '_' || lower(monthname(o_orderdate)) AS folder, count(*) AS n FROM orders GROUP BY 1""")
def folder_names_sql(spark, sf):
    """Folder names by the function that SQL text can call."""
    sql_functions.register_folder_name(spark)
    return spark.sql(
        "SELECT get_folder_name(year(o_orderdate), month(o_orderdate), 'zurich') AS folder, count(*) AS n FROM {orders} GROUP BY 1",
        orders=table(spark, sf, "orders"))


_FLAGS = """
SELECT d.doc_id, coalesce(l.quality, 0) <> 0 AS quality,
  CASE WHEN d.doc_id % 5 = 0 THEN false WHEN d.doc_id % 7 = 0 THEN true ELSE coalesce(l.toxic, 0) <> 0 END AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)"""


@query(_FLAGS)
def flags_to_bool(spark, sf):
    """Nulls and NaN are false, 0.5 is false, 2 is true."""
    doc = F.col("doc_id")
    toxic = F.when(doc % 10 == 0, F.lit(float("nan"))).when(doc % 5 == 0, F.lit(0.5)).when(
        doc % 7 == 0, F.lit(2.0)
    ).otherwise(F.col("toxic").cast("double"))
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", flag("quality").alias("quality"), flag(toxic).alias("toxic"))


@query("""
SELECT doc_id, doc_id % 9 <> 0 AND doc_id % 14 <> 0 AS nonblank FROM documents""")
def nonblank_text(spark, sf):
    doc = F.col("doc_id")
    spaces = F.when(doc % 2 == 0, F.lit(" \u00a0\n\t")).otherwise(F.lit("\x1c\u2003\x85"))
    text = F.when(doc % 14 != 0, F.when(doc % 9 == 0, spaces).otherwise(F.col("text")))
    return table(spark, sf, "documents").select("doc_id", nonblank(text).alias("nonblank"))


TEMPLATE = "Does any label apply?\n=======\n{content_text}\n\nANSWER (costs $1 or \\0)\n======="


@query(f"""
SELECT doc_id, md5(replace('{TEMPLATE}', '{{content_text}}', text)) AS prompt_md5,
  length(replace('{TEMPLATE}', '{{content_text}}', text)) AS prompt_length FROM documents""")
def prompt_render(spark, sf):
    prompt = fill_template(TEMPLATE, "text")
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(prompt.cast("binary")).alias("prompt_md5"),
        F.length(prompt).cast("long").alias("prompt_length"),
    )


@query("""
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
e AS (SELECT vec_id, v, list_transform(v, lambda x: exp(x - list_max(v))) AS p FROM s)
SELECT vec_id, CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS best,
  round(1 / list_sum(p), 6) AS best_probability, round(p[1] / list_sum(p), 6) AS first_probability FROM e""")
def softmax_scores(spark, sf):
    scores = F.transform("embedding", lambda x: x.cast("double"))
    rows = table(spark, sf, "embeddings").select("vec_id", scores.alias("v"))
    rows = rows.select("vec_id", argmax_index("v").alias("best"), softmax("v").alias("p"))
    return rows.select(
        "vec_id", "best", F.round(F.array_max("p"), 6).alias("best_probability"),
        F.round(F.col("p")[0], 6).alias("first_probability"),
    )


@query(f"""
WITH n AS (SELECT doc_id, lang, row_number() OVER (ORDER BY lang, doc_id) - 1 AS row_no FROM documents)
SELECT *, row_no // {ARCHIVES_PER_TASK} AS chunk FROM n""")
def chunk_assign(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return with_chunks(docs, ["lang", "doc_id"], ARCHIVES_PER_TASK)


@query("""
WITH d AS (SELECT *, CAST(doc_id // 2 AS VARCHAR) AS meta_id, CAST(doc_id // 2 % 28 + 1 AS INTEGER) AS date FROM documents)
SELECT meta_id, 2024 AS year, 1 AS month, date, text AS content, lang, source AS type, n_chars AS collection_timestamp
FROM d WHERE doc_id // 2 % 40 <> 0
QUALIFY row_number() OVER (PARTITION BY meta_id, date ORDER BY doc_id DESC) = 1""")
def subtitle_batch(spark, sf):
    """Documents as scanned subtitle rows: dated, last per key, stored columns only."""
    half = F.floor(F.col("doc_id") / 2)
    name = F.when(half % 40 == 0, "0_undated_subtitles.parquet").otherwise(
        F.format_string("0_2024-01-%02d_00_00_subtitles.parquet", half % 28 + 1)
    )
    scanned = table(spark, sf, "documents").select(
        half.cast("string").alias("meta_id"), F.col("text").alias("content"), "lang",
        F.col("source").alias("type"), F.col("n_chars").cast("double").alias("collection_timestamp"),
        F.lit(1).alias("not_stored"), name.alias("source_filename"), name.alias("source_path"),
        F.col("doc_id").alias("row_index"),
    )
    return prepare(scanned, KINDS["subtitles"])
