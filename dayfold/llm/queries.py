"""One query for each operator, over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import classifier, decontamination, hard_negatives, jaccard, lempel_ziv, licenses, mixing, pii, prefix_trie, setsketch, substrings, urls, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that stand in a 13-word window of a benchmark item."""
    hits = decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document from a discriminant fitted to the labels that are not held out."""
    return classifier.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of all sources takes."""
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


# Fixed values of the contract: rules as host and path.
BLOCKED_RULES = [("net", "/"), ("example.com", "/de/")]
ALLOWED_RULES = [("example.net", "/en/"), ("org", "/fr/")]


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages; listed are the pages that some URL reaches with a tracking parameter."""
    pages = table(spark, sf_dir, "pages")
    tracked = pages.filter(F.col("url").rlike(r"[?&]utm_[a-z]+="))
    listed = tracked.select(urls.canonical(F.col("url")).alias("canonical"))
    out = urls.filter_urls(pages, listed, urls.rules_table(spark, BLOCKED_RULES, ALLOWED_RULES), ["page_id"])
    return out.select("page_id", "host", "path", "rule", "verdict")


SQL["op5_url_filter"] = r"""
WITH cut AS (
    SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), parts AS (
    SELECT page_id, url,
        coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
        regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query
    FROM cut
), named AS (
    SELECT *, regexp_replace(regexp_replace(host, ':(80|443)?$', ''), '^(www|m)\.', '') AS name,
        list_sort(list_filter(string_split(query, '&'),
            lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS kept
    FROM parts
), pages_c AS (
    SELECT *, CASE WHEN name <> '' THEN name || regexp_replace(path, '/+$', '')
        || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
    FROM named
), listed AS (
    SELECT DISTINCT canonical FROM pages_c WHERE canonical IS NOT NULL AND regexp_matches(url, '[?&]utm_[a-z]+=')
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitting AS (
    SELECT p.page_id, p.url, r.rule_host || r.rule_path AS rule, r.verdict,
        row_number() OVER (PARTITION BY p.url ORDER BY length(r.rule_host || r.rule_path) DESC) AS n
    FROM (SELECT DISTINCT page_id, url, host, path FROM pages_c) p
    JOIN rules r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
), best AS (SELECT DISTINCT url, rule, verdict FROM fitting WHERE n = 1)
SELECT p.page_id, p.host, p.path, b.rule,
    coalesce(b.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM pages_c p LEFT JOIN best b ON p.url = b.url LEFT JOIN listed l ON p.canonical = l.canonical
"""


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template matches of each document."""
    rows = licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    starts = F.transform("base", lambda b: b["first_word"])
    base = F.transform("base", lambda b: b["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, "matches")).alias("labels"), "score",
    )


@query
def op7_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back, one row per record."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates in place of personal data, and the number of mentions."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs, count="n_mentions")


@query
def op3_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    return lempel_ziv.compared_with_next(table(spark, sf_dir, "documents"))


@query
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without its repeated windows of 20 words."""
    rows = substrings.without_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_WORDS_OF = r"""coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""
SQL["op1_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS_OF} AS words FROM documents),
i AS (SELECT item_id, {_WORDS_OF} AS words FROM benchmark),
iw AS (SELECT item_id, words, least(13, len(words)) AS k, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS p
  FROM i WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, k, words[p:p + k - 1] AS w FROM iw),
dk AS (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS p
  FROM d, (SELECT DISTINCT k FROM windows) WHERE len(words) >= k),
found AS (SELECT dk.doc_id, dk.p, dk.k, windows.item_id FROM dk JOIN windows ON dk.k = windows.k AND dk.words[dk.p:dk.p + dk.k - 1] = windows.w),
places AS (SELECT DISTINCT doc_id, unnest(range(p, p + k)) AS at FROM found),
n AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(words) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


# CRC-32 of the decimal id: bytes of digits, each followed by eight steps of one bit (-1).
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(range(1, len(s) + 1),
    lambda i: list_concat([CAST(ascii(substr(s, i, 1)) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1])))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""
SQL["op11_prefix_trie"] = f"""
WITH own AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), named AS (SELECT conv_id, turns, CAST(conv_id AS VARCHAR) AS s FROM own
), told AS (SELECT conv_id, turns, ({_CRC}) % 4 AS h FROM named
), rebuilt AS (
    SELECT t.conv_id, list_concat(coalesce(b.turns[1:t.h], []), t.turns[t.h + 1:]) AS turns
    FROM told t LEFT JOIN own b ON b.conv_id = t.conv_id - t.conv_id % 20
), prefixes AS (
    SELECT conv_id, len(turns) AS n, d, turns[1:d] AS path FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256,
        CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) END AS words
    FROM prefixes GROUP BY path, d
), children AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path, d)
), above AS (SELECT path[1:k] AS top, k, n_convs, words, n_children FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM counted)
), sums AS (
    SELECT top AS path, k AS d, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
    FROM above GROUP BY ALL
)
SELECT c.conv_id, CAST(c.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN sums USING (path, d) LEFT JOIN nodes p ON c.d > 0 AND p.d = c.d - 1 AND p.path = c.path[1:c.d - 1]
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, against all of them."""
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(
        table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, F.col("vec_id"), changed, F.col("embedding"))


SQL["op12_hard_negatives"] = """
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
    FROM v a JOIN v r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query
def op13_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document, and the one of it that is kept."""
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))
