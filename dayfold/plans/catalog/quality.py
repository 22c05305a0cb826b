"""Queries for table checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import quality as ops
from .registry import query, table


def _rules(spark, sf):
    fulfilled = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    return [
        ops.not_null("flag"),
        ops.in_range("l_discount", 0, 0.09),
        ops.allowed("l_linestatus", ["O"]),
        ops.fits_decimal("l_extendedprice", 6, 2),
        ops.unique("l_orderkey", "l_linenumber"),
        ops.references("l_orderkey", fulfilled, "o_orderkey"),
    ]


_L = "l AS (SELECT *, CASE WHEN l_partkey % 50 <> 0 THEN l_returnflag END AS flag FROM lineitem)"
_BROKEN = {
    "flag not null": "flag IS NULL",
    "l_discount in range": "l_discount < 0 OR l_discount > 0.09",
    "l_linestatus allowed": "l_linestatus <> 'O'",
    "l_extendedprice fits decimal(6,2)": "TRY_CAST(l_extendedprice AS DECIMAL(6,2)) IS NULL",
}
_ORPHAN = "l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"
_REPEATS = """(SELECT l_orderkey, l_linenumber, count(*) AS n FROM l GROUP BY ALL HAVING count(*) > 1)"""


def _lines(spark, sf):
    return table(spark, sf, "lineitem").withColumn(
        "flag", F.when(F.col("l_partkey") % 50 != 0, F.col("l_returnflag"))
    )


@query("WITH " + _L + " " + " UNION ALL ".join(
    [f"SELECT '{name}' AS rule, count(*) AS violations FROM l WHERE {broken}" for name, broken in _BROKEN.items()]
    + [
        f"SELECT 'l_orderkey, l_linenumber unique', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM {_REPEATS}",
        f"SELECT 'l_orderkey references o_orderkey', count(*) FROM l WHERE {_ORPHAN}",
    ]
))
def constraint_report(spark, sf):
    return ops.check(_lines(spark, sf), _rules(spark, sf))


@query("WITH " + _L + ", v AS (" + " UNION ALL ".join(
    [f"SELECT l_orderkey, l_linenumber, '{name}' AS rule FROM l WHERE {broken}" for name, broken in _BROKEN.items()]
    + [
        f"SELECT l.l_orderkey, l.l_linenumber, 'l_orderkey, l_linenumber unique' FROM l JOIN {_REPEATS} r "
        "ON l.l_orderkey = r.l_orderkey AND l.l_linenumber = r.l_linenumber",
        f"SELECT l_orderkey, l_linenumber, 'l_orderkey references o_orderkey' FROM l WHERE {_ORPHAN}",
    ]
) + ") SELECT l_orderkey, rule, count(*) AS rows FROM v GROUP BY ALL")
def constraint_violations(spark, sf):
    rows = ops.violations(_lines(spark, sf), _rules(spark, sf))
    return rows.groupBy("l_orderkey", "rule").agg(F.count("*").alias("rows"))
