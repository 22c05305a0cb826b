"""Queries that go through files: drops, tables, archives and manifests."""

from __future__ import annotations

import datetime as dt
import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F

from ...model import COMMENT_KEY, DAY, KINDS
from ...operators.quality import in_range
from ...session import work_path
from ...sources import archives, drops, tar_members
from ...sources.drops import open_file
from ...sources.results import append_batch, append_day, read_batches, read_table, replace_days, rows_of_days
from ..ingest import ingest
from . import derived
from .derived import DROP_TYPES, EVENTS_SQL, sql_day, sql_types
from .registry import SQL, query, table

NOW = dt.datetime(2024, 2, 1)


@query("""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value ELSE CAST(floor(value) AS DOUBLE) END AS value,
  CASE WHEN event_id % 2 = 0 THEN props END AS props,
  CASE WHEN event_id % 2 = 1 THEN user_id END AS user_id FROM events""")
def schema_drift_union(spark, sf):
    """Drops of one kind: floating point, text and no user in some, whole numbers and no text in others."""
    root = work_path(spark, "drift")
    even = F.col("event_id") % 2 == 0
    rows = table(spark, sf, "events").select(
        F.when(even, "one").otherwise("two").alias("kind"),
        F.date_format("ts", "yyyy-MM-dd_00_00").alias("slot"),
        *[
            F.col(c).alias(f"{kind}__{c}")
            for kind, names in (("one", ["event_id", "value", "props"]), ("two", ["event_id", "user_id"]))
            for c in names
        ],
        F.floor("value").alias("two__value"),
    )
    derived.write_drops(rows, root)
    scanned, _ = drops.scan_kind(spark, root, "*")
    return scanned.select("event_id", "value", "props", "user_id")


@query("""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value ELSE CAST(floor(value) AS DOUBLE) END AS value,
  CASE WHEN event_id % 2 = 0 THEN props END AS props FROM events""")
def schema_drift_arrow(spark, sf):
    """Whole and floating numbers under one name, and text that some drops lack."""
    root = work_path(spark, "drift")
    even = F.col("event_id") % 2 == 0
    rows = table(spark, sf, "events").select(
        F.when(even, "one").otherwise("two").alias("kind"),
        F.date_format("ts", "yyyy-MM-dd_00_00").alias("slot"),
        F.col("event_id").alias("one__event_id"), F.col("value").alias("one__value"),
        F.col("props").alias("one__props"),
        F.col("event_id").alias("two__event_id"), F.floor("value").alias("two__value"),
    )
    derived.write_drops(rows, root)
    scanned, _ = drops.scan_kind(spark, root, "*")
    return scanned.select("event_id", "value", "props")


@query("""
WITH e AS (SELECT event_id, 7345678901234567000 + event_id AS big, ts FROM events)
SELECT CASE event_id % 3 WHEN 0 THEN CAST(big AS VARCHAR) WHEN 1 THEN CAST(event_id AS VARCHAR) ELSE 'id-' || event_id END AS meta_id
FROM e WHERE NOT (event_id % 3 = 1 AND event_id % 5 = 0)
UNION ALL SELECT NULL FROM e WHERE event_id % 3 = 1 AND event_id % 5 = 0""")
def drift_keys(spark, sf):
    """Ids as large whole numbers in some drops, floating point with gaps in others, and text in the rest."""
    root = work_path(spark, "drift-keys")
    third = F.col("event_id") % 3
    rows = table(spark, sf, "events").select(
        F.element_at(F.array(F.lit("a_metadata"), F.lit("b_metadata"), F.lit("c_metadata")), (third + 1).cast("int")).alias("kind"),
        F.date_format("ts", "yyyy-MM-dd_00_00").alias("slot"),
        (F.col("event_id") + 7345678901234567000).alias("a_metadata__meta_id"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_id").cast("double")).alias("b_metadata__meta_id"),
        F.concat(F.lit("id-"), F.col("event_id").cast("string")).alias("c_metadata__meta_id"),
    )
    derived.write_drops(rows, root)
    return drops.scan_kind(spark, root, "metadata")[0].select("meta_id")


@query("""
WITH e AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN 'undated' WHEN event_id % 11 = 1 THEN 'null key'
    WHEN event_id % 11 = 2 THEN 'does not fit: stats_playcount' END AS reason FROM events)
SELECT coalesce(reason, 'stored or replaced') AS reason, count(*) AS rows FROM e GROUP BY ALL
UNION ALL SELECT 'unreadable file', NULL
UNION ALL SELECT 'stored', count(*) FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM e WHERE reason IS NULL)""")
def ingest_rejects(spark, sf):
    """All events as drops, some without a date, an id or a number that fits, and one broken file."""
    root, tables = work_path(spark, "drops"), work_path(spark, "tables")
    number = F.col("event_id") % 11
    rows = table(spark, sf, "events").select(
        F.lit("metadata").alias("kind"), "ts", "event_id",
        F.when(number == 0, "sometime").otherwise(F.date_format("ts", "yyyy-MM-dd_00_00")).alias("slot"),
        F.when(number != 1, F.col("user_id").cast("string")).alias("metadata__meta_id"),
        F.col("event_id").cast("double").alias("metadata__stats_diggcount"),
        F.when(number == 2, "many").otherwise(F.col("event_id").cast("string")).alias("metadata__stats_playcount"),
    )
    derived.write_drops(rows.repartitionByRange("ts", "event_id").sortWithinPartitions("ts", "event_id"), root)
    system, folder = open_file(root)
    with system.open_output_stream(f"{folder}/9_2024-01-01_00_00_metadata.parquet") as out:
        out.write(b"broken")
    outcome = ingest(spark, root, tables, NOW, kinds=["metadata"])["metadata"]
    if outcome["error"]:
        raise RuntimeError(outcome["error"])
    rejects = outcome["rejects"].groupBy("reason").agg(F.sum("rows").alias("rows"))
    stored = read_table(spark, f"{tables}/metadata", KINDS["metadata"].table_schema)
    kept = stored.agg(F.lit("stored").alias("reason"), F.count("*").alias("rows"))
    refused = rejects.agg(F.sum("rows").alias("n"))
    rest = table(spark, sf, "events").agg(F.count("*").alias("all")).join(refused).select(
        F.lit("stored or replaced").alias("reason"), (F.col("all") - F.col("n")).alias("rows"))
    return rejects.unionByName(rest).unionByName(kept)


@query(f"""
WITH {EVENTS_SQL},
e AS (SELECT *, event_id % 11 AS n, CASE WHEN {sql_types(*DROP_TYPES["metadata"])} THEN 'metadata' ELSE 'comments' END AS kind FROM ev),
k AS (SELECT * FROM e WHERE n > 2
  QUALIFY row_number() OVER (PARTITION BY kind, meta_id, year, month, date ORDER BY ts DESC, event_id DESC) = 1),
s AS (SELECT kind, count(*) AS rows_scanned, count(*) FILTER (WHERE n = 0) AS undated,
    count(*) FILTER (WHERE n = 1) AS null_keys, count(*) FILTER (WHERE n = 2) AS misfits
  FROM e GROUP BY kind),
a AS (SELECT kind, count(*) AS rows_after, count(*) FILTER (WHERE event_id % 1000 > 900) AS broken FROM k GROUP BY kind)
SELECT kind, rows_scanned, undated, null_keys, misfits, rows_scanned - undated - null_keys - misfits AS rows_before, rows_after,
  rows_scanned - undated - null_keys - misfits - rows_after AS rows_removed, broken
FROM s JOIN a USING (kind)""")
def load_report(spark, sf):
    """All events as metadata and comment drops; what the load says about its rows as it stores them."""
    root, tables = work_path(spark, "drops"), work_path(spark, "tables")
    number = F.col("event_id") % 11
    rows = derived.keyed_events(spark, sf).select(
        F.when(F.col("event_type").isin(*DROP_TYPES["metadata"]), "metadata").otherwise("comments").alias("kind"), "ts", "event_id",
        F.when(number == 0, "sometime").otherwise(F.date_format("ts", "yyyy-MM-dd_00_00")).alias("slot"),
        *[F.when(number != 1, F.col("meta_id")).alias(f"{kind}__meta_id") for kind in ("metadata", "comments")],
        F.lit("c").alias("comments__cid"),
        *[F.when(number == 2, "many").otherwise((F.col("event_id") % 1000).cast("string")).alias(c)
          for c in ("metadata__stats_playcount", "comments__digg_count")],
    )
    derived.write_drops(rows.repartitionByRange("ts", "event_id").sortWithinPartitions("ts", "event_id"), root)
    outcome = ingest(spark, root, tables, NOW, kinds=["metadata", "comments"], rules={
        "metadata": [in_range("stats_playcount", 0, 900)], "comments": [in_range("digg_count", 0, 900)]})
    failed = {k: o["error"] for k, o in outcome.items() if o["error"]}
    if failed:
        raise RuntimeError(f"ingest failed: {failed}")
    counts = ("rows_scanned", "rows_before", "rows_after", "rows_removed")
    return spark.createDataFrame(
        [(kind, *[o["report"][c] for c in counts], *o["report"]["refused"].values(), *o["report"]["broken"].values())
         for kind, o in outcome.items()],
        f"kind string, {', '.join(f'{c} long' for c in (*counts, *drops.REFUSED, 'broken'))}")


@query("""
SELECT event_id, value FROM events
WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)""")
def scan_one_day(spark, sf):
    """All events as drops; those of the last day are read by the names of their files."""
    root = work_path(spark, "days")
    events = table(spark, sf, "events")
    last = events.agg(F.date_format(F.max("ts"), "yyyy-MM-dd").alias("d")).first()["d"]
    rows = events.repartitionByRange("ts", "event_id").sortWithinPartitions("ts", "event_id").select(
        F.lit("metadata").alias("kind"), F.date_format("ts", "yyyy-MM-dd_00_00").alias("slot"),
        F.col("event_id").alias("metadata__event_id"), F.col("value").alias("metadata__value"))
    derived.write_drops(rows, root)
    return drops.scan_kind(spark, root, "metadata", pattern=f"*_{last}_*_metadata.parquet")[0].select("event_id", "value")


_LAST = """
QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ts DESC, event_id DESC) = 1"""
_KEY = "meta_id, year, month, date"
_FLAG = "coalesce(CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 3 - 1 END, 0) <> 0"


@query(f"""
WITH {EVENTS_SQL},
a AS (SELECT 'metadata' AS kind, meta_id, year, month, date, CAST(NULL AS VARCHAR) AS cid, props AS content,
    {_FLAG} AS flag, CAST(0 AS BIGINT) AS defaulted FROM ev WHERE {sql_types(*DROP_TYPES['metadata'])} {_LAST.format(key=_KEY)}),
b AS (SELECT 'comments', meta_id, year, month, date, CAST(event_id AS VARCHAR) AS cid, props, {_FLAG},
    CAST(0 AS BIGINT) FROM ev WHERE {sql_types(*DROP_TYPES['comments'])} {_LAST.format(key=_KEY + ", event_id")}),
c AS (SELECT 'subtitles', meta_id, year, month, date, CAST(NULL AS VARCHAR), props,
    CASE WHEN value > {derived.VALUE_LIMIT} THEN true END, CAST(NULL AS BIGINT)
    FROM ev WHERE {sql_types(*DROP_TYPES['subtitles'])} {_LAST.format(key=_KEY)})
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""")
def ingest_drops(spark, sf):
    """All events written as drops, ingested into the three tables, and read back."""
    root, tables = work_path(spark, "drops"), work_path(spark, "tables")
    derived.write_event_drops(spark, sf, root)
    outcome = ingest(spark, root, tables, NOW)
    failed = {k: o["error"] for k, o in outcome.items() if o["error"]}
    if failed:
        raise RuntimeError(f"ingest failed: {failed}")
    stored = {k: read_table(spark, f"{tables}/{k}", KINDS[k].table_schema) for k in KINDS}
    key = COMMENT_KEY[1:]
    no_cid = F.lit(None).cast("string").alias("cid")
    return (
        stored["metadata"].select(
            F.lit("metadata").alias("kind"), *key, no_cid, F.col("meta_desc").alias("content"),
            F.col("meta_secret").alias("flag"), F.col("stats_diggcount").alias("defaulted"),
        )
        .unionByName(stored["comments"].select(
            F.lit("comments").alias("kind"), *key, "cid", F.col("comment_text").alias("content"),
            F.col("author_pin").alias("flag"), F.col("reply_count").alias("defaulted"),
        ))
        .unionByName(stored["subtitles"].select(
            F.lit("subtitles").alias("kind"), *key, no_cid, "content",
            F.when(F.col("lang") == "en", True).alias("flag"),
            F.lit(None).cast("long").alias("defaulted"),
        ))
    )


@query(f"""
WITH {EVENTS_SQL} SELECT year, month, date, count(*) AS rows, round(sum(value), 2) AS total FROM ev GROUP BY ALL""")
def append_days(spark, sf):
    """Two appends to a table by day, read back."""
    path = work_path(spark, "days")
    rows = derived.keyed_events(spark, sf).drop("ts")
    append_day(rows.filter(F.col("event_type") == "view"), path)
    append_day(rows.filter(F.col("event_type") != "view"), path)
    return spark.read.parquet(path).groupBy(*DAY).agg(
        F.count("*").alias("rows"), F.round(F.sum("value"), 2).alias("total")
    )


@query(SQL["append_days"])
def append_days_twice(spark, sf):
    """Two batches of which one is appended again, and one after a batch of the same id with other rows."""
    path = work_path(spark, "batches")
    rows = derived.keyed_events(spark, sf).drop("ts")
    view, other = rows.filter(F.col("event_type") == "view"), rows.filter(F.col("event_type") != "view")
    append_batch(view, path, "view")
    append_batch(rows.filter("value > 50"), path, "other")
    append_batch(view, path, "view")
    append_batch(other, path, "other")
    return read_batches(spark, path, rows.schema).groupBy(*DAY).agg(
        F.count("*").alias("rows"), F.round(F.sum("value"), 2).alias("total")
    )


@query(f"""
WITH {EVENTS_SQL}, m AS (SELECT event_id, meta_id, year, month, date FROM ({derived.sql_kept(*derived.METADATA)}))
SELECT * FROM m WHERE (year, month, date) IN (SELECT (year, month, date) FROM ev WHERE user_id % 50 = 7 AND event_type = 'error')""")
def stored_days(spark, sf):
    """Rows of a stored table on the days of other rows, which prune its partitions as the query runs."""
    path = work_path(spark, "stored")
    rows = derived.kept_events(spark, sf, *derived.METADATA).select("event_id", "meta_id", *DAY)
    replace_days(rows, path)
    wanted = derived.keyed_events(spark, sf, "error").filter("user_id % 50 = 7")
    return rows_of_days(spark, path, rows.schema, wanted)


def write_archives(df, root: str) -> None:
    """Write rows ``name, text`` as tar.xz archives from within tasks, one per Arrow batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        system, folder = open_file(root)
        system.create_dir(folder, recursive=True)
        for part, frame in enumerate(frames):
            path = f"{folder}/{task}-{part}_0_2024-01-01_{part % 24:02d}_00.tar.xz"
            with system.open_output_stream(path) as out:
                with tarfile.open(fileobj=out, mode="w|xz") as tar:
                    for name, text in zip(frame["name"], frame["text"]):
                        data = text.encode()
                        info = tarfile.TarInfo(name)
                        info.size = len(data)
                        tar.addfile(info, io.BytesIO(data))
            yield pd.DataFrame({"rows": [len(frame)]})

    df.mapInPandas(run, "rows long").agg(F.sum("rows")).collect()


def _turn_archives(spark, sf) -> str:
    """A folder of archives with a member per conversation turn, its ending told by the role."""
    root = work_path(spark, "archives")
    suffix = F.when(F.col("role") == "user", ".mp3").when(F.col("role") == "assistant", ".MP3").otherwise(".txt")
    rows = table(spark, sf, "conversations").select(
        F.concat(F.format_string("c%d/%d", "conv_id", "turn"), suffix).alias("name"), "text"
    )
    write_archives(rows, root)
    return root


@query("""
SELECT 'c' || conv_id || '/' || turn || '.mp3' AS member, octet_length(encode(text)) AS size, md5(text) AS md5
FROM conversations WHERE role = 'user'""")
def archive_members(spark, sf):
    """Conversation turns written into archives; only members ending in .mp3 come back."""
    root = _turn_archives(spark, sf)
    members, _ = archives.explode_archives(archives.scan_archives(spark, root), ".mp3", content=True)
    return members.select("member", "size", F.md5("content").alias("md5"))


@query(SQL["archive_members"])
def tar_source(spark, sf):
    """The same members by the data source, the condition on their names pushed down to it."""
    tar_members.register(spark)
    members = spark.read.format("tar_members").option("content", "true").load(_turn_archives(spark, sf))
    return members.filter(F.col("member").endswith(".mp3")).select("member", "size", F.md5("content").alias("md5"))


@query(f"""
WITH {EVENTS_SQL},
n AS (SELECT strftime(ts, '0_%Y-%m-%d_%H_%M') || '_' || event_id || '.tar.xz' AS name FROM ev WHERE {sql_types('view', 'purchase')}
  UNION ALL SELECT strftime(ts, '0_%Y-%m-%d_%H_%M') || '_' || event_id || '.parquet' FROM ev WHERE {sql_types('click', 'error', 'signup')})
SELECT name, 'source/' || name AS source_path, 'target/' || name AS destination_path FROM n
WHERE contains(name, '2024-01-1')""")
def manifest_filter(spark, sf):
    def listing(kinds: list[str], suffix: str):
        return table(spark, sf, "events").filter(F.col("event_type").isin(kinds)).select(
            F.concat(
                F.lit("0_"), F.date_format("ts", "yyyy-MM-dd_HH_mm"), F.lit("_"),
                F.col("event_id").cast("string"), F.lit(suffix),
            ).alias("name")
        )

    return archives.manifest(
        [listing(["click", "error", "signup"], ".parquet"), listing(["view", "purchase"], ".tar.xz")], "2024-01-1", "source/", "target/"
    )
