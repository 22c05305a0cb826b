"""Queries for batch scoring with a small deterministic scorer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import day_text
from ...model import DAY
from ...operators import scoring as ops
from ...session import work_path
from ..classify import classify, merge
from . import derived
from .derived import EVENTS_SQL, METADATA, sql_kept, sql_types
from .registry import query, table


def make_length_scorer():
    """A scorer that SQL can mirror: everything follows from the length of the text."""

    def one(text: str):
        n = len(text)
        if n % 41 == 0:
            raise ValueError("length divides by 41")
        p = (n % 97) / 96.0
        token = "?" if n % 10 == 3 else "1" if p > 0.5 else "0"
        return token, 1.0 - p, p

    return lambda texts: [one(t) for t in texts]


_SCORED = """
WITH s AS (SELECT doc_id, length(text) AS n, (length(text) % 97) / 96.0::DOUBLE AS p FROM documents),
r AS (SELECT doc_id, CASE WHEN n % 10 = 3 THEN '?' WHEN p > 0.5 THEN '1' ELSE '0' END AS decoded_token, p
  FROM s WHERE n % 41 <> 0)
SELECT doc_id, decoded_token, CAST(CASE WHEN decoded_token = '1' THEN 1 ELSE 0 END AS INTEGER) AS classification,
  round(1.0 - p, 6) AS prob_0, round(p, 6) AS prob_1 FROM r"""


def _shown(df):
    return df.select(
        "doc_id", "decoded_token", "classification",
        F.round("prob_0", 6).alias("prob_0"), F.round("prob_1", 6).alias("prob_1"),
    )


@query(_SCORED)
def score_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return _shown(ops.results(ops.score(docs, "text", make_length_scorer)))


@query("SELECT doc_id, 'length divides by 41' AS error FROM documents WHERE length(text) % 41 = 0")
def score_failures(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return ops.failures(ops.score(docs, "text", make_length_scorer)).select("doc_id", "error")


@query(_SCORED)
def score_resumed(spark, sf):
    """Labelled documents are scored in a first run, the others in a second."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels")
    path = work_path(spark, "scored")
    ops.score_resumable(docs, "text", make_length_scorer, ["doc_id"], path, rows_per_save=400, only=labels)
    done, _ = ops.score_resumable(docs, "text", make_length_scorer, ["doc_id"], path, rows_per_save=400)
    return _shown(done)


@query(f"""
WITH {EVENTS_SQL},
c AS (SELECT meta_id, year, month, date, props || repeat('x', CAST(event_id % 90 AS INTEGER)) AS content
  FROM ev WHERE {sql_types('error', 'click', 'purchase')}),
s AS (SELECT *, length(content) AS n, (length(content) % 97) / 96.0::DOUBLE AS p FROM c),
r AS (SELECT *, CASE WHEN n % 10 = 3 THEN '?' WHEN p > 0.5 THEN '1' ELSE '0' END AS decoded_token
  FROM s WHERE n % 41 <> 0),
m AS (SELECT meta_id, year, month, date, props AS meta_desc FROM ({sql_kept(*METADATA)}))
SELECT r.meta_id, r.year, r.month, r.date AS day, content, decoded_token,
  CAST(CASE WHEN decoded_token = '1' THEN 1 ELSE 0 END AS INTEGER) AS classification, round(p, 6) AS prob_1, meta_desc
FROM r JOIN m USING (meta_id, year, month, date)""")
def classify_and_merge(spark, sf):
    """Errors, clicks and purchases as subtitle drops, scored and saved, then joined to the metadata drops of their days."""
    root, scored, classified, output = (
        work_path(spark, f"classify-{x}") for x in ("drops", "scored", "done", "merged")
    )
    slot = F.concat(day_text(*DAY), F.lit("_00_00")).alias("slot")
    padding = F.repeat(F.lit("x"), (F.col("event_id") % 90).cast("int"))
    derived.write_drops(derived.keyed_events(spark, sf, "error", "click", "purchase").select(
        F.lit("subtitles").alias("kind"), slot, F.col("meta_id").alias("subtitles__meta_id"),
        F.concat("props", padding).alias("subtitles__content"),
    ), root)
    derived.write_drops(derived.kept_events(spark, sf, *METADATA).select(
        F.lit("metadata").alias("kind"), slot, F.col("meta_id").alias("metadata__meta_id"),
        F.col("props").alias("metadata__meta_desc"),
    ), root)
    done, _ = classify(spark, root, make_length_scorer, scored, rows_per_save=400)
    done.write.parquet(classified)
    return merge(spark, classified, root, output).select(
        "meta_id", "year", "month", "day", "content", "decoded_token", "classification",
        F.round("prob_1", 6).alias("prob_1"), "meta_desc",
    )
