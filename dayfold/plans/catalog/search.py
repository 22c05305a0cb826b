"""Queries for text search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...model import STOP_WORDS
from ...operators import search as ops
from ...session import work_path
from .registry import query, table

_TOKENS = f"""
WITH w AS (SELECT doc_id AS doc, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+')) AS token
  FROM documents),
p AS (SELECT token, doc, count(*) AS times FROM w
  WHERE token <> '' AND token NOT IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}) GROUP BY ALL)"""
SOUGHT = "The onen, thou and RESH"


@query(f"{_TOKENS} SELECT token, doc, times FROM p")
def token_postings(spark, sf):
    return ops.postings(table(spark, sf, "documents"), "doc_id", "text")


@query(f"{_TOKENS} SELECT token, count(*) AS docs, CAST(sum(times) AS BIGINT) AS times FROM p GROUP BY token")
def token_counts(spark, sf):
    index = ops.postings(table(spark, sf, "documents"), "doc_id", "text")
    return index.groupBy("token").agg(F.count("*").alias("docs"), F.sum("times").alias("times"))


_HITS = "SELECT doc, count(*) AS matched, CAST(sum(times) AS BIGINT) AS times FROM p WHERE token IN ('onen', 'thou', 'resh') GROUP BY doc"


@query(f"{_TOKENS} {_HITS} HAVING count(*) = 3")
def search_all(spark, sf):
    """Search in a written index."""
    path = work_path(spark, "postings")
    ops.write_postings(ops.postings(table(spark, sf, "documents"), "doc_id", "text", ranged=True), path, ranged=True)
    return ops.search_all(ops.load_postings(spark, path), SOUGHT)


@query(f"{_TOKENS} {_HITS}")
def search_any(spark, sf):
    index = ops.postings(table(spark, sf, "documents"), "doc_id", "text")
    return ops.search_any(index, SOUGHT)


PHRASE, NEAR, WITHIN = "Attion to thanedble the anea", "anea and attion", 6
_PLACES = """
WITH l AS (SELECT doc_id AS doc, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}_]+'), lambda x: x <> '') AS words
  FROM documents),
w AS (SELECT doc, unnest(words) AS token, unnest(range(len(words))) AS place FROM l)"""


@query(f"""{_PLACES}
SELECT a.doc, count(*) AS times FROM w a JOIN w b ON b.doc = a.doc AND b.place = a.place + 2 AND b.token = 'thanedble'
JOIN w c ON c.doc = a.doc AND c.place = a.place + 4 AND c.token = 'anea' WHERE a.token = 'attion' GROUP BY a.doc""")
def search_phrase(spark, sf):
    """A phrase with stop words in it, sought in a written index of places."""
    path = work_path(spark, "places")
    ops.write_postings(ops.positions(table(spark, sf, "documents"), "doc_id", "text", ranged=True), path, ranged=True)
    return ops.search_phrase(ops.load_postings(spark, path), PHRASE)


@query(f"""{_PLACES},
n AS (SELECT doc, place, count(DISTINCT token) OVER (PARTITION BY doc ORDER BY place RANGE BETWEEN CURRENT ROW AND {WITHIN - 1} FOLLOWING) AS near
  FROM w WHERE token IN ('anea', 'attion'))
SELECT doc, CAST(min(place) AS INTEGER) AS start FROM n WHERE near = 2 GROUP BY doc""")
def search_near(spark, sf):
    return ops.search_near(ops.positions(table(spark, sf, "documents"), "doc_id", "text"), NEAR, WITHIN)


# Words in other scripts and with combining marks, put before every third document's text.
_FOREIGN = ["नमस्ते", "cafe\u0301", "мир", "Straße"]
_FOREIGN_SQL = f"""
WITH d AS (SELECT doc_id, CASE doc_id % 5 {' '.join(f"WHEN {i} THEN '{w} '" for i, w in enumerate(_FOREIGN))} ELSE '' END || text AS text
  FROM documents),
w AS (SELECT doc_id AS doc, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+')) AS token FROM d),
p AS (SELECT token, doc, count(*) AS times FROM w GROUP BY ALL)
SELECT doc, count(*) AS matched, CAST(sum(times) AS BIGINT) AS times FROM p
WHERE token IN ({", ".join(f"'{w.lower()}'" for w in _FOREIGN)}) GROUP BY doc"""


@query(_FOREIGN_SQL)
def search_scripts(spark, sf):
    """Search for words in several scripts, cut like the documents' own."""
    word = F.element_at(F.array(*[F.lit(w + " ") for w in _FOREIGN], F.lit("")), (F.col("doc_id") % 5 + 1).cast("int"))
    docs = table(spark, sf, "documents").withColumn("text", F.concat(word, "text"))
    return ops.search_any(ops.postings(docs, "doc_id", "text"), ", ".join(_FOREIGN))
