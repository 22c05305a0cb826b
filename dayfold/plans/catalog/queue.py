"""Queries for the processing queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...model import DAY
from ...operators import queue as ops
from ...sources.intake import parse_lines
from ..monitor import recent_completions as report
from . import derived
from .derived import QUEUE_ROWS_SQL, QUEUE_SQL, STATUS_FOLD_COLUMNS, STATUS_FOLD_SQL, sql_day, stamp
from .registry import query, table

_MICROS = "(epoch_us(processing_end) - epoch_us(processing_start))"


@query(f"""
WITH {QUEUE_SQL},
n AS (SELECT {sql_day("l_shipdate")}, count(*) AS files FROM lineitem GROUP BY ALL),
top AS (SELECT * FROM q WHERE status = 'completed'
  ORDER BY processing_end DESC NULLS FIRST, year, month, date LIMIT 10)
SELECT {derived.sql_day_text("top.")} AS date,
  CASE WHEN {_MICROS} >= 86400000000 THEN {_MICROS} // 86400000000 ||
    CASE WHEN {_MICROS} // 86400000000 = 1 THEN ' day, ' ELSE ' days, ' END ELSE '' END ||
  ({_MICROS} % 86400000000 // 3600000000) || ':' ||
  lpad(CAST({_MICROS} % 3600000000 // 60000000 AS VARCHAR), 2, '0') || ':' ||
  lpad(CAST({_MICROS} % 60000000 // 1000000 AS VARCHAR), 2, '0') AS duration,
  {_MICROS} / 1000000.0 AS duration_seconds, coalesce(n.files, 0) AS files
FROM top LEFT JOIN n USING (year, month, date)""")
def recent_completions(spark, sf):
    shipped = derived.with_day(table(spark, sf, "lineitem").select("l_shipdate"), "l_shipdate")
    return report(derived.queue(spark, sf), shipped)


@query(f"""
WITH {QUEUE_ROWS_SQL}
SELECT DISTINCT year, month, date, location FROM qr p WHERE status = 'pending' AND NOT EXISTS (
  SELECT 1 FROM qr r WHERE r.status IN ('transferring', 'processing')
    AND r.year = p.year AND r.month = p.month AND r.date = p.date)
ORDER BY year, month, date, location LIMIT 5""")
def dispatchable_days(spark, sf):
    return ops.dispatchable(derived.queue_rows(spark, sf), 5)


@query(f"""
WITH {QUEUE_ROWS_SQL}
SELECT year, month, date, count(*) AS jobs FROM qr WHERE status IN ('transferring', 'processing') GROUP BY ALL""")
def running_days(spark, sf):
    return ops.running_days(derived.queue_rows(spark, sf)).groupBy(*DAY).agg(F.count("*").alias("jobs"))


@query(f"""
WITH {QUEUE_SQL}
SELECT coalesce((SELECT location FROM q WHERE year = 1998 AND month = 8 AND date = 2), 'zurich') AS location
UNION ALL
SELECT coalesce((SELECT location FROM q WHERE year = 2030 AND month = 1 AND date = 1), 'zurich')""")
def location_lookup(spark, sf):
    from ...model import DEFAULT_LOCATION

    rows = derived.queue(spark, sf)
    known = ops.location_of(rows, 1998, 8, 2, DEFAULT_LOCATION)
    return known.unionByName(ops.location_of(rows, 2030, 1, 1, DEFAULT_LOCATION))


@query(STATUS_FOLD_SQL)
def status_fold(spark, sf):
    events = derived.status_events(table(spark, sf, "events"))
    out = ops.fold_status(events, ["user_id"], "ts", "event_id")
    return out.withColumns({c: stamp(c) for c in STATUS_FOLD_COLUMNS})


def intake_lines(spark, sf):
    """An intake line per order, with every kind of mistake among them."""
    key = F.col("o_orderkey")
    month = F.date_format("o_orderdate", "MMMM")
    number = F.month("o_orderdate").cast("string")
    name = (
        F.when(key % 19 == 0, F.concat(F.lit("x"), month))
        .when(key % 4 == 0, month)
        .when(key % 4 == 1, F.upper(F.substring(month, 1, 3)))
        .when((key % 4 == 2) & (number == "9"), "Sept")
        .otherwise(number)
    )
    day = F.when(key % 13 == 0, "32").when(key % 31 == 0, "first").otherwise(
        F.dayofmonth("o_orderdate").cast("string")
    )
    line = F.concat_ws(
        ", ", F.year("o_orderdate").cast("string"), name, day,
        F.when(key % 17 != 0, F.col("o_orderpriority")),
    )
    line = F.when(key % 23 == 0, F.concat(F.lit(" # "), line)).when(key % 29 == 0, "  ").otherwise(line)
    return table(spark, sf, "orders").select("o_orderkey", line.alias("line"))


_INTAKE_SQL = """
WITH l AS (SELECT o_orderkey, concat_ws(', ', CAST(year(o_orderdate) AS VARCHAR),
    CASE WHEN o_orderkey % 19 = 0 THEN 'x' || monthname(o_orderdate)
      WHEN o_orderkey % 4 = 0 THEN monthname(o_orderdate)
      WHEN o_orderkey % 4 = 1 THEN upper(monthname(o_orderdate)[1:3])
      WHEN o_orderkey % 4 = 2 AND month(o_orderdate) = 9 THEN 'Sept'
      ELSE CAST(month(o_orderdate) AS VARCHAR) END,
    CASE WHEN o_orderkey % 13 = 0 THEN '32' WHEN o_orderkey % 31 = 0 THEN 'first'
      ELSE CAST(day(o_orderdate) AS VARCHAR) END,
    CASE WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END) AS body FROM orders),
s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 23 = 0 THEN ' # ' || body WHEN o_orderkey % 29 = 0 THEN '  '
    ELSE body END AS line FROM l),
p AS (SELECT *, list_transform(string_split(trim(line), ','), lambda x: trim(x)) AS f FROM s
      WHERE trim(line) <> '' AND trim(line) NOT LIKE '#%'),
v AS (SELECT *, TRY_CAST(f[1] AS BIGINT) AS y, TRY_CAST(f[3] AS BIGINT) AS d,
    CASE WHEN regexp_matches(lower(f[2]), '^(january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sep|sept|oct|nov|dec)$')
      THEN (list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], lower(f[2])[1:3]))
      WHEN TRY_CAST(f[2] AS INTEGER) BETWEEN 1 AND 12 THEN TRY_CAST(f[2] AS INTEGER) END AS m FROM p),
r AS (SELECT *, CASE WHEN len(f) <> 4 THEN 'field_count' WHEN y IS NULL OR d IS NULL THEN 'not_integer'
    WHEN m IS NULL THEN 'bad_month' WHEN y NOT BETWEEN 2000 AND 2030 THEN 'year_range'
    WHEN d NOT BETWEEN 1 AND 31 THEN 'day_range' END AS reason FROM v)"""


@query(_INTAKE_SQL + """
SELECT o_orderkey, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, CAST(d AS INTEGER) AS date,
  f[4] AS location FROM r WHERE reason IS NULL""")
def queue_intake(spark, sf):
    return parse_lines(intake_lines(spark, sf), "o_orderkey")[0]


@query(_INTAKE_SQL + "SELECT o_orderkey, line, reason FROM r WHERE reason IS NOT NULL")
def queue_rejects(spark, sf):
    return parse_lines(intake_lines(spark, sf), "o_orderkey")[1]


@query("""
SELECT o_orderkey, o_orderpriority AS location FROM orders
WHERE o_orderpriority LIKE '%URGENT%' AND o_orderstatus IN ('F', 'P')
  AND year(o_orderdate) = 1998 AND month(o_orderdate) = 8""")
def queue_filter(spark, sf):
    rows = derived.queue_rows(spark, sf)
    wanted = F.col("location").like("%URGENT%") & F.col("status").isin("completed", "processing")
    return rows.filter(wanted & (F.col("year") == 1998) & (F.col("month") == 8)).select(
        "o_orderkey", "location"
    )


@query(f"""
WITH {QUEUE_ROWS_SQL},
w AS (SELECT year, month, date, count(*) FILTER (WHERE status <> 'pending') AS workers,
  count(*) FILTER (WHERE status = 'completed') AS ok,
  count(*) FILTER (WHERE status = 'processing') AS failed FROM qr GROUP BY ALL)
SELECT *, CASE WHEN workers = 0 THEN 'processing_failed' WHEN failed = 0 THEN 'completed' ELSE 'completed_with_errors' END AS status,
  CASE WHEN workers = 0 THEN 'No tar.xz files found' WHEN failed > 0 THEN failed || ' worker jobs failed' END AS error_message
FROM w""")
def day_outcomes(spark, sf):
    """Orders that are not pending stand for a day's workers; days without any have no archives."""
    status = F.col("status")
    counts = derived.queue_rows(spark, sf).groupBy(*DAY).agg(
        F.count_if(status != "pending").alias("workers"),
        F.count_if(status == "completed").alias("ok"),
        F.count_if(status == "processing").alias("failed"),
    )
    return ops.day_outcome(counts)
