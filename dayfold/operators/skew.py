"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import common_type
from ..session import work_path

# A key with more rows than this on one side is spread there over as many tasks as it takes to give
# each about so many.
HOT_ROWS = 2_000_000

# Hot keys that are broadcast; more of them are joined like any other table.
BROADCAST_KEYS = 500_000


def _shared_type(key: str, a: str, b: str) -> str:
    """The type to hash a key by, so that keys that are equal hash alike on both sides."""
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    if a == b and a not in ("float", "double"):
        return a
    if {a, b} <= numbers:
        return common_type([a, b, "double"]) if {a, b} & {"float", "double"} else common_type([a, b])
    if all(t in numbers or t.startswith("decimal") for t in (a, b)):
        return "double"
    raise TypeError(f"key {key} is {a} on the left and {b} on the right")


def key_hash(keys: Sequence[str], types: Mapping[str, str]) -> Column:
    """One number per key; equal keys get equal numbers whatever type their side has."""
    parts = []
    for k in keys:
        part = F.col(k).cast(types[k])
        parts.append(part + F.lit(0.0) if types[k] == "double" else part)
    return F.xxhash64(*parts)


def hot_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], types: Mapping[str, str], hot_rows: int
) -> DataFrame:
    """Hashes of keys with more than ``hot_rows`` rows on a side, and over how many cells either
    side is spread: ``__hash``, ``__left`` and ``__right``.

    Rows are counted exactly, by partial sums of the keys alone. The table is written, so both
    sides of the join see the same cells.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        per_key = df.select(key_hash(keys, types).alias("__hash")).groupBy("__hash").agg(F.count("*").alias("n"))
        return per_key.filter(F.col("n") > hot_rows).select("__hash", F.ceil(F.col("n") / max(hot_rows, 1)).cast("int").alias(name))

    spark = left.sparkSession
    path = work_path(spark, "hot-keys")
    both = counted(left, "__left").join(counted(right, "__right"), "__hash", "full_outer")
    both.na.fill(1, ["__left", "__right"]).write.parquet(path)
    found = spark.read.parquet(path)
    return F.broadcast(found) if found.count() <= BROADCAST_KEYS else found


def all_equal(left: str, right: str, keys: Sequence[str], null_safe: Sequence[str]) -> Column:
    """Equality on the keys of two aliased frames; null matches null on the null-safe ones."""
    terms = [
        F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
        if k in null_safe
        else F.col(f"{left}.{k}") == F.col(f"{right}.{k}")
        for k in keys
    ]
    return reduce(lambda a, b: a & b, terms)


def salted_inner_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    null_safe: Sequence[str] = (),
    left_spread: Sequence[str] = (),
    right_spread: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner equi-join that spreads keys which are hot on either side over many tasks.

    Rows of a key that is hot on their own side get one of as many numbers as that side has cells
    for the key; rows of the other side are repeated once per number. Both numbers join with the
    key, so every pair appears exactly once, and no cell gets much more than ``hot_rows`` rows of a
    side. All other keys stay in cell (0, 0), unrepeated. ``left_spread`` and ``right_spread`` name
    columns that tell the rows of one key apart (default: all). Apart from the keys the sides
    must not share column names.
    """
    types = {k: _shared_type(k, dict(left.dtypes)[k], dict(right.dtypes)[k]) for k in keys}
    hot = hot_keys(left, right, keys, types, hot_rows)

    def cells(df: DataFrame, spread: Sequence[str], own: str, other: str, own_cells: str, other_cells: str) -> DataFrame:
        many, repeated = F.coalesce(own_cells, F.lit(1)), F.coalesce(other_cells, F.lit(1))
        number = F.pmod(F.xxhash64(*spread), many).cast("int")
        hashed = df.withColumn("__hash", key_hash(keys, types))
        return hashed.join(hot, "__hash", "left").select(
            *df.columns,
            number.alias(own),
            F.explode(F.sequence(F.lit(0), repeated - 1)).alias(other),
        )

    one = cells(left, list(left_spread) or left.columns, "__i", "__j", "__left", "__right")
    two = cells(right, list(right_spread) or right.columns, "__j", "__i", "__right", "__left")
    on = all_equal("l", "r", [*keys, "__i", "__j"], null_safe)
    rest = [c for c in right.columns if c not in keys]
    return one.alias("l").join(two.alias("r"), on, "inner").select(
        *[F.col(f"l.{c}").alias(c) for c in left.columns],
        *[F.col(f"r.{c}").alias(c) for c in rest],
    )
