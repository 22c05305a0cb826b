"""Dated Parquet drops whose columns and types drift from file to file.

Spark fails on a column that is whole numbers in one file and floating point (or all null) in
another. So the footers are read first, by tasks; files whose types agree are read together, each
group in its own types, by Spark's reader. Every group's columns are then cast straight to the type
they are stored in, or to the common type of columns that have none. Every readable row is kept,
values that do not fit their stored type are named in ``misfits``, and every unreadable file is
reported.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import islice

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions import common_type, file_day, file_month, file_year, flag, has_file_date
from ..functions.text import whole_number
from ..model import DAY, KINDS, Kind
from ..operators.keyed import keep_last
from ..operators.quality import refuse_case_clash
from ..session import scale_to, work_path

STRICT_NAME = r"_\d{4}-\d{2}-\d{2}_\d{2}_\d{2}_[a-z]+\.parquet$"
FILE_ORDER = ["source_filename", "source_path", "row_index"]
LOCATION = [
    T.StructField("source_path", T.StringType()),
    T.StructField("source_filename", T.StringType()),
    T.StructField("row_index", T.LongType()),
]

# Names of columns whose value did not fit the stored type of its column.
MISFITS = T.StructField("misfits", T.ArrayType(T.StringType(), False), False)

# Files named in one call of the reader. Groups of more files are read in several calls; Spark
# keeps the list of files of a scan on the driver in any case.
FILES_PER_READ = 20_000
# Task counts only.
FOOTERS_PER_TASK = 200
MAX_TASKS = 20_000

_FOOTERS = (
    "path string, length long, row_groups array<long>, columns string, error string"
)


def list_files(
    spark: SparkSession, root: str | Sequence[str], pattern: str, recursive: bool = False
) -> DataFrame:
    """Path and length of the files whose name fits, without reading them."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(root if isinstance(root, str) else list(root))
        .select("path", "length")
    )


def one_task_each(items: DataFrame) -> DataFrame:
    """Spread rows that stand for much work over as many tasks, evenly.

    The number is given, as adaptive execution would put a few thousand names in one task.
    """
    return items.repartition(max(1, min(items.count(), MAX_TASKS)))


def open_file(path: str):
    """File system and path of a location as Spark writes it."""
    for ours, theirs in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if path.startswith(ours):
            path = theirs + path[len(ours):]
    return fs.FileSystem.from_uri(path)


def _footer(path: str, verify: bool) -> tuple[list[int] | None, str | None, str | None]:
    try:
        system, name = open_file(path)
        with system.open_input_file(name) as f:
            footer = pq.ParquetFile(f)
            columns = {
                c.name: "null" if pa.types.is_null(c.type) else _spark_type(c.type)
                for c in footer.schema_arrow
            }
            meta = footer.metadata
            counts = [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
            if verify:
                for _ in footer.iter_batches():
                    pass
        return counts, json.dumps(columns, sort_keys=True), None
    except Exception as error:  # noqa: BLE001 - any unreadable file is reported, not fatal
        return None, None, f"{type(error).__name__}: {error}"


def _spark_type(t: pa.DataType) -> str:
    from pyspark.sql.pandas.types import from_arrow_type

    if pa.types.is_dictionary(t):
        t = t.value_type
    if pa.types.is_large_string(t):
        t = pa.string()
    return from_arrow_type(t, prefer_timestamp_ntz=True).simpleString()


def read_footers(files: DataFrame, verify: bool = False) -> DataFrame:
    """Row groups, columns and types, or an error, of each file.

    ``verify`` decodes all its pages as well, which finds files that broke below the footer.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [_footer(p, verify) for p in frame["path"]]
            yield frame.assign(
                row_groups=[f[0] for f in found],
                columns=[f[1] for f in found],
                error=[f[2] for f in found],
            )

    return files.select("path", "length").mapInPandas(run, _FOOTERS)


def _type(text: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {text}").fields[0].dataType


def _groups(mixes: list[dict[str, str]]) -> list[dict]:
    """Put type mixes together as long as no column has two types; missing columns agree."""
    groups: list[dict] = []
    for number, mix in enumerate(mixes):
        for group in groups:
            types = group["types"]
            if all(types.get(c, t) == t for c, t in mix.items()):
                types.update(mix)
                group["members"].append(number)
                break
        else:
            groups.append({"types": dict(mix), "members": [number]})
    return groups


# Whole numbers up to here have a floating-point number of their own.
_EXACT = 1 << 53


def fitted(value: Column, source: str, target: T.DataType) -> tuple[Column, Column]:
    """A value of a file's type in the stored type, and whether it is there but does not fit.

    NaN is a missing value, as in files that pandas wrote. A floating-point number is text only if
    it is sure which whole number it was, and a whole number only if it is one. Text is a number if
    it spells one; blank text is missing. Decimals are rounded to their scale.
    """
    wanted = target.simpleString()
    real, text = source in ("float", "double"), source == "string"
    if real:
        value = F.when(~F.isnan(value), value)
        whole = value == F.floor(value)
    if isinstance(target, T.StringType):
        if not real:
            return value.cast("string"), F.lit(False)
        sure = F.abs(value) < _EXACT
        out = F.when(whole & sure, value.try_cast("bigint").cast("string")).when(~whole, value.cast("string"))
        return out, value.isNotNull() & out.isNull()
    if isinstance(target, (T.LongType, T.IntegerType)):
        if text:
            value = F.when(F.trim(value) != "", value)
            out = whole_number(F.trim(value), wanted)
        elif real:
            out = F.when(whole, value.try_cast(wanted))
        else:
            out = value.try_cast(wanted)
        return out, value.isNotNull() & out.isNull()
    if isinstance(target, T.DecimalType):
        if text:
            value = F.when(F.trim(value) != "", value)
        out = value.try_cast(wanted)
        return out, value.isNotNull() & out.isNull()
    out = value.try_cast(target)
    return out, value.isNotNull() & out.isNull()


def _read(
    spark: SparkSession, paths: Sequence[str], types: dict[str, str], target: T.StructType,
    stored: Mapping[str, T.DataType], **options,
) -> DataFrame:
    """Files of one group: its types, its columns cast to those of the target."""
    present = [f for f in target.fields if types.get(f.name, "null") != "null"]
    schema = T.StructType([T.StructField(f.name, _type(types[f.name])) for f in present])
    df = spark.read.options(**options).schema(schema).parquet(*paths)
    there = {f.name for f in present}
    columns, misfits = [], []
    for f in target.fields:
        if f.name not in there:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name in stored:
            value, wrong = fitted(F.col(f.name), types[f.name], f.dataType)
            columns.append(value.alias(f.name))
            misfits.append(F.when(wrong, F.lit(f.name)))
        else:
            columns.append(F.col(f.name).cast(f.dataType).alias(f.name))
    names = F.array_compact(F.array(*misfits)) if misfits else F.array().cast(MISFITS.dataType)
    return df.select(
        *columns,
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_name").alias("source_filename"),
        F.col("_metadata.row_index").alias("row_index"),
        names.alias(MISFITS.name),
    )


def _in_parts(rows: Iterator, size: int) -> Iterator[list[str]]:
    while part := [r["path"] for r in islice(rows, size)]:
        yield part


def scan_files(
    files: DataFrame,
    columns: Sequence[str] | None = None,
    root: str | None = None,
    verify: bool = False,
    kind: Kind | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Rows of all readable files, and ``path, error`` of the unreadable ones.

    Rows come with ``source_path``, ``source_filename``, ``row_index`` and ``misfits``, null where a
    file lacks a column. Columns that ``kind`` stores have their stored type, others the common
    type of all files. ``columns`` limits what is read. With ``root`` and ``options`` given, files
    that all agree are read straight from the folder, so their names never pass through the driver.
    A file whose footer is sound but whose pages are not stops the job when it is read; ``verify``
    reads all files first and reports it.
    """
    spark = files.sparkSession
    count, size = files.agg(F.count("*"), F.sum("length")).first()
    scale_to(spark, size or 0)
    at_once = spark.sparkContext.defaultParallelism * 4
    tasks = max(1, min(at_once, count // FOOTERS_PER_TASK))
    path = work_path(spark, "footers")
    read_footers(files.repartition(tasks), verify).write.parquet(path)
    footers = spark.read.schema(_FOOTERS).parquet(path)
    bad = footers.filter(F.col("error").isNotNull()).select("path", "error")
    good = footers.filter(F.col("error").isNull())

    # One row per mix of types: the driver sees what differs, not the files.
    mixes = [r["columns"] for r in good.select("columns").distinct().orderBy("columns").toLocalIterator()]
    parsed = [json.loads(m) for m in mixes]
    kinds: dict[str, set[str]] = {}
    for mix in parsed:
        for name, type_name in mix.items():
            kinds.setdefault(name, set()).add(type_name)
    refuse_case_clash(list(kinds))
    stored = kind.scan_types if kind else {}
    wanted = sorted(kinds) if columns is None else [c for c in columns if c in kinds]
    target = T.StructType([T.StructField(c, stored.get(c) or _type(common_type(kinds[c]))) for c in wanted])
    groups = _groups([{c: t for c, t in mix.items() if c in wanted} for mix in parsed])
    if not groups:
        known = target if not kind else T.StructType([T.StructField(c, t) for c, t in stored.items()])
        return spark.createDataFrame([], T.StructType([*known.fields, *LOCATION, MISFITS])), bad
    if len(groups) == 1 and root is not None and bad.isEmpty():
        return _read(spark, [root], groups[0]["types"], target, stored, **options), bad
    parts = []
    for group in groups:
        members = [mixes[i] for i in group["members"]]
        paths = good.filter(F.col("columns").isin(members)).select("path").toLocalIterator()
        parts += [_read(spark, p, group["types"], target, stored) for p in _in_parts(paths, FILES_PER_READ)]
    return reduce(DataFrame.unionByName, parts), bad


def scan_kind(
    spark: SparkSession,
    root: str,
    kind: str,
    recursive: bool = False,
    strict: bool = False,
    pattern: str | None = None,
    columns: Sequence[str] | None = None,
    verify: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """All drops of a kind under a folder: their rows, and the files that could not be read.

    ``recursive`` looks into subfolders; ``strict`` takes only names with a whole 10-minute slot.
    """
    pattern = pattern or f"*_{kind}.parquet"
    files = list_files(spark, root, pattern, recursive)
    options = {"pathGlobFilter": pattern, "recursiveFileLookup": str(recursive).lower()}
    if strict:
        strict_files = files.filter(F.col("path").rlike(STRICT_NAME))
        return scan_files(strict_files, columns, verify=verify, kind=KINDS.get(kind))
    return scan_files(files, columns, root, verify, KINDS.get(kind), **options)


def scan_day(spark: SparkSession, root: str, kind: str, date: str, **more) -> tuple[DataFrame, DataFrame]:
    """The drops of one day, chosen by name while listing."""
    return scan_kind(spark, root, kind, pattern=f"0_{date}_*_{kind}.parquet", **more)


def scan_kinds(
    spark: SparkSession, root: str, kinds: Sequence[str] = tuple(KINDS), **more
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """The chosen kinds, each by itself."""
    return {kind: scan_kind(spark, root, kind, **more) for kind in kinds}


def with_file_date(df: DataFrame, day: str = "date") -> DataFrame:
    """Year, month and day from the file name; rows of undated files are left out."""
    name = "source_filename"
    return df.filter(has_file_date(name)).withColumns({
        "year": file_year(name), "month": file_month(name), day: file_day(name),
    })


def undated(df: DataFrame) -> DataFrame:
    """Files without a date in their name, with the rows that were left out for it."""
    return df.filter(~has_file_date("source_filename")).groupBy("source_path").agg(
        F.count("*").alias("rows")
    )


def rename_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that are there."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def canonical(df: DataFrame, kind: Kind) -> DataFrame:
    """The stored columns that are present, in stored order and type; flags become booleans."""
    df = rename_present(df, kind.renames)
    out = []
    for field in kind.schema.fields:
        if field.name not in df.columns:
            continue
        value = flag(field.name) if field.name in kind.flags else F.col(field.name)
        out.append(value.try_cast(field.dataType).alias(field.name))
    return df.select(*out)


# Counts of refused rows by the start of their reason.
REFUSED = {"undated": "undated", "misfits": "does not fit", "null_keys": "null key"}
REJECTS = "reason string, source_path string, row_index long, rows long, detail string"


def sort_out(
    scanned: DataFrame, kind: Kind, allow_null_key: bool = False, seen: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that can be stored, with their date, and those that cannot, with the reason.

    A row is refused if its file has no date in its name, if a key column is null, or if a value
    does not fit its column; ``detail`` then has the whole row. Rows are sorted out before those
    with equal keys are, so none disappears among its likes. ``seen`` is told how many rows there
    were and how many were refused for what, when the refused ones are written.
    """
    keys = [c for c in kind.key if c not in DAY]  # the day is that of the file
    named = {b: a for a, b in kind.renames.items()}
    lacking = [k for k in keys if k not in scanned.columns and named.get(k) not in scanned.columns]
    rows = scanned.withColumns({k: F.lit(None).cast("string") for k in lacking}) if lacking else scanned
    null_key = F.lit(False) if allow_null_key else reduce(lambda a, b: a | b, [F.col(named.get(k, k)).isNull() for k in keys])
    misfits = F.col(MISFITS.name) if MISFITS.name in rows.columns else F.array().cast(MISFITS.dataType)
    reason = (
        F.when(~has_file_date("source_filename"), "undated")
        .when(F.size(misfits) > 0, F.concat(F.lit("does not fit: "), F.array_join(misfits, ", ")))
        .when(null_key, "null key")
    )
    marked = rows.withColumn("__reason", reason)
    fine = with_file_date(marked.filter(F.col("__reason").isNull()).drop("__reason", MISFITS.name))
    content = F.to_json(F.struct(*[c for c in scanned.columns if c not in [f.name for f in (*LOCATION, MISFITS)]]))
    told = marked if seen is None else marked.observe(
        seen, F.count(F.lit(1)).alias("scanned"),
        *[F.count_if(F.col("__reason").startswith(start)).alias(name) for name, start in REFUSED.items()])
    refused = told.filter(F.col("__reason").isNotNull()).select(
        F.col("__reason").alias("reason"), "source_path", "row_index", F.lit(1).cast("long").alias("rows"),
        content.alias("detail"),
    )
    return fine, refused


def unreadable(bad: DataFrame) -> DataFrame:
    """Unreadable files in the form of refused rows; how many rows they had is not known."""
    return bad.select(
        F.lit("unreadable file").alias("reason"), F.col("path").alias("source_path"),
        F.lit(None).cast("long").alias("row_index"), F.lit(None).cast("long").alias("rows"), F.col("error").alias("detail"),
    )


def prepare(df: DataFrame, kind: Kind) -> DataFrame:
    """Scanned rows to a batch: date, last row per key, stored columns and types."""
    return canonical(keep_last(sort_out(df, kind)[0], kind.key, FILE_ORDER), kind)
