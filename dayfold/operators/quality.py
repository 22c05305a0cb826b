"""Table checks: what the stored tables' constraints mean, counted on data.

``check`` counts all row rules in one pass. Keys and references need a shuffle each, of counts
per key rather than rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class RowRule:
    """A rule that one row keeps or breaks; ``holds`` undecided (null) keeps it."""

    name: str
    holds: Column

    def broken(self) -> Column:
        return ~F.coalesce(self.holds, F.lit(True))


@dataclass(frozen=True)
class Unique:
    name: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    name: str
    column: str
    parent: DataFrame
    parent_column: str


def not_null(column: str) -> RowRule:
    return RowRule(f"{column} not null", F.col(column).isNotNull())


def in_range(column: str, low=None, high=None) -> RowRule:
    terms = []
    if low is not None:
        terms.append(F.col(column) >= low)
    if high is not None:
        terms.append(F.col(column) <= high)
    return RowRule(f"{column} in range", reduce(lambda a, b: a & b, terms))


def allowed(column: str, values: Sequence[str]) -> RowRule:
    return RowRule(f"{column} allowed", F.col(column).isin(list(values)))


def fits_decimal(column: str, precision: int, scale: int) -> RowRule:
    """Rounded to the scale, the value must not need more digits than the precision."""
    value = F.col(column)
    if precision <= 15:
        # A double holds the bound exactly; comparing costs no exception per value that breaks it.
        fits = F.abs(F.round(value.try_cast("double"), scale)) < float(10 ** (precision - scale))
        fits = F.coalesce(fits, F.lit(False))
    else:
        fits = value.try_cast(f"decimal({precision},{scale})").isNotNull()
    return RowRule(f"{column} fits decimal({precision},{scale})", value.isNull() | fits)


def unique(*keys: str) -> Unique:
    return Unique(f"{', '.join(keys)} unique", keys)


def references(column: str, parent: DataFrame, parent_column: str) -> Reference:
    return Reference(f"{column} references {parent_column}", column, parent, parent_column)


def _with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def _repeats(df: DataFrame, rule: Unique) -> DataFrame:
    counts = _with_key(df, rule.keys).groupBy(*rule.keys).agg(F.count("*").alias("__n"))
    return counts.filter(F.col("__n") > 1)


def _orphans(df: DataFrame, rule: Reference) -> DataFrame:
    counts = _with_key(df, [rule.column]).groupBy(rule.column).agg(F.count("*").alias("__n"))
    parents = rule.parent.select(F.col(rule.parent_column).alias(rule.column)).distinct()
    return counts.join(parents, rule.column, "left_anti")


def check(df: DataFrame, rules: Sequence[RowRule | Unique | Reference]) -> DataFrame:
    """One row per rule: its name and the number of rows that break it.

    A repeated key counts all its rows but one.
    """
    parts = []
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    if row_rules:
        counted = df.agg(*[
            F.coalesce(F.count_if(r.broken()), F.lit(0)).alias(f"r{i}")
            for i, r in enumerate(row_rules)
        ])
        parts.append(counted.select(F.inline(F.array(*[
            F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("violations"))
            for i, r in enumerate(row_rules)
        ]))))
    for rule in rules:
        if isinstance(rule, Unique):
            n = _repeats(df, rule).agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("violations"))
        elif isinstance(rule, Reference):
            n = _orphans(df, rule).agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("violations"))
        else:
            continue
        parts.append(n.select(F.lit(rule.name).alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def violations(df: DataFrame, rules: Sequence[RowRule | Unique | Reference]) -> DataFrame:
    """Rows that break a rule, once per rule, with its name in ``rule``."""
    parts = []
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    if row_rules:
        broken = F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in row_rules]))
        parts.append(df.withColumn("rule", F.explode(broken)))
    for rule in rules:
        if isinstance(rule, Unique):
            keys = list(rule.keys)
            bad = df.join(_repeats(df, rule).select(*keys), keys, "left_semi")
        elif isinstance(rule, Reference):
            parents = rule.parent.select(F.col(rule.parent_column).alias(rule.column)).distinct()
            bad = _with_key(df, [rule.column]).join(parents, rule.column, "left_anti")
        else:
            continue
        parts.append(bad.withColumn("rule", F.lit(rule.name)))
    return reduce(DataFrame.unionByName, parts)


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "data") -> None:
    """Raise if a column is missing; reads nothing but the schema."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")


def refuse_case_clash(columns: Sequence[str]) -> None:
    """Raise if two names differ only by case, which Spark would take for one column."""
    seen: dict[str, str] = {}
    for name in columns:
        other = seen.setdefault(name.lower(), name)
        if other != name:
            raise ValueError(f"columns {other} and {name} differ only by case")


def describe_schema(
    spark: SparkSession, tables: Mapping[str, DataFrame], defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Columns of tables in order: position, name, type, nullable, default."""
    defaults = defaults or {}
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable,
         None if f.name not in defaults else str(defaults[f.name]))
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, position int, column_name string, data_type string, "
        "nullable boolean, default_value string",
    )


def columns_per_type(described: DataFrame) -> DataFrame:
    return described.groupBy("table_name", "data_type").agg(F.count("*").alias("columns"))
