"""Keyed tables: keep one row per key, upsert, insert-if-absent, delete, resume.

Keeping one row per key is written as ``row_number() = 1``. Spark turns that filter into a
group limit that runs before the shuffle too, so a task sends at most one row per key and a
key that holds a third of all rows costs each task one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import surrogate_id

_RANK = "__rank"


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``; null keys are one key, as are equal values.

    ``order`` should end in something unique, or ties fall either way.
    """
    return _one_per_key(df, keys, [F.col(c).desc() for c in order])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, [F.col(c).asc() for c in order])


def dedup_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before, rows after and rows removed by keeping one per key."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a whole key, and rows to set aside because a key column is null."""
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return df.filter(whole), df.filter(~whole)


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add columns that are absent with their default; a null that is there stays null."""
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    now,
    defaults: Mapping[str, object] | None = None,
    id_column: str = "id",
    created_column: str = "created_at",
    updated_column: str = "updated_at",
) -> DataFrame:
    """The target after inserting or updating the rows of a batch, one row per key on each side.

    Known keys take the columns the batch has, null or not, and keep the others; ``id`` and the
    creation time stay. New keys take the batch's columns, defaults for the rest, and an id made
    of the key. Only touched rows get a new update time, which is the given ``now``.
    """
    defaults = dict(defaults or {})
    foreign = [c for c in batch.columns if c not in target.columns]
    if foreign:
        raise ValueError(f"batch columns the target lacks: {foreign}")
    given = {c for c in batch.columns if c not in keys}
    moment = now if isinstance(now, Column) else F.lit(now)

    old = target.withColumn("__old", F.lit(True)).alias("t")
    new = batch.select(
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        *[F.col(c).alias(f"__new_{c}") for c in sorted(given)],
        F.lit(True).alias("__new"),
    )
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & (F.col(f"t.{k}") == F.col(f"__key_{k}"))
    known, touched = F.col("__old").isNotNull(), F.col("__new").isNotNull()

    def value(field) -> Column:
        name, kept = field.name, F.col(f"t.{field.name}")
        if name in keys:
            out = F.coalesce(kept, F.col(f"__key_{name}"))
        elif name in given:
            out = F.when(touched, F.col(f"__new_{name}")).otherwise(kept)
        elif name == id_column:
            out = F.when(known, kept).otherwise(surrogate_id(*[f"__key_{k}" for k in keys]))
        elif name == created_column:
            out = F.when(known, kept).otherwise(moment)
        elif name == updated_column:
            out = F.when(touched, moment).otherwise(kept)
        else:
            out = F.when(known, kept).otherwise(F.lit(defaults.get(name)))
        return out.cast(field.dataType).alias(name)

    return old.join(new, same_key, "full_outer").select(*[value(f) for f in target.schema.fields])


def insert_absent(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """The target plus batch rows whose key it lacks; the first of equal batch keys wins."""
    first = with_defaults(keep_first(batch, keys, order), defaults or {})
    fresh = first.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select([c for c in target.columns if c in fresh.columns]),
                              allowMissingColumns=True)


def skip_existing(
    target: DataFrame, batch: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Batch rows whose key the target lacks, and those skipped because it has them."""
    there = target.select(*keys).distinct()
    return batch.join(there, list(keys), "left_anti"), batch.join(there, list(keys), "left_semi")


def pending(items: DataFrame, done: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Items without a result yet. ``key`` may be an output path: existing outputs are skipped."""
    keys = [key] if isinstance(key, str) else list(key)
    return items.join(done.select(*keys).distinct(), keys, "left_anti")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """The rows left after a delete; rows the condition does not decide stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def delete_cascade(
    parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, condition: Column
) -> tuple[DataFrame, DataFrame]:
    """Parents and children left after deleting parents, and with them their children."""
    gone = parent.filter(condition).select(F.col(parent_key).alias(child_key)).distinct()
    return delete_where(parent, condition), child.join(gone, child_key, "left_anti")
