"""Batch scoring of texts with a pluggable model, with retry, reports and resume.

A scorer takes a list of texts and returns one ``(token, prob_0, prob_1)`` per text. It is made
by a function that is called once per task, so a model loads once per task, not per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import TEMPLATE_SLOT, label_of_token, nonblank
from ..session import work_path
from ..sources.results import exists
from .keyed import keep_last, pending

Scorer = Callable[[list[str]], Sequence[tuple[str, float, float]]]
MakeScorer = Callable[[], Scorer]

SCORES = "__scores"

# Rows that one task scores at most, if rows are spread or saved, and rows after which results are saved.
ROWS_PER_TASK = 20_000
ROWS_PER_SAVE = 1_000_000

# Keys that one task holds at most, on average, to tell by them what is left of its rows.
KEYS_PER_TASK = 500_000

SCORE_FIELDS = [
    T.StructField("decoded_token", T.StringType()),
    T.StructField("prob_0", T.DoubleType()),
    T.StructField("prob_1", T.DoubleType()),
    T.StructField("error", T.StringType()),
]


def load_template(path: str) -> str:
    """A prompt template file; a missing file is an error."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _score_rows(scorer: Scorer, texts: list[str]) -> list[tuple]:
    """Scores of a batch; if the batch fails, of its rows one by one, with errors in place."""
    try:
        found = list(scorer(texts))
        if len(found) != len(texts):
            raise ValueError(f"{len(found)} scores for {len(texts)} texts")
        return [(*row, None) for row in found]
    except Exception as batch_error:  # noqa: BLE001 - a scorer may raise anything
        if len(texts) == 1:
            return [(None, None, None, str(batch_error) or type(batch_error).__name__)]
        return [row for text in texts for row in _score_rows(scorer, [text])]


def score(
    df: DataFrame,
    text: str,
    make_scorer: MakeScorer,
    batch_size: int = 16,
    template: str | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Rows with non-blank text plus token, label, probabilities and, if scoring failed, an error.

    Only the text goes to Python and only the scores come back; all other columns stay in the
    JVM. ``template`` puts each text into a prompt. ``spread_by`` names unique columns to
    redistribute rows by, for input whose files differ much in size and a scorer that costs far
    more than a shuffle. The rows then go to as many tasks as their number asks for: adaptive
    execution would merge them by size, not by scoring time.
    """
    rows = df.filter(nonblank(text))
    if spread_by:
        rows = rows.repartition(scoring_tasks(df.sparkSession, rows.count()), *spread_by)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for part in parts:
            prompts = [template.replace(TEMPLATE_SLOT, t) if template else t for t in part]
            scored: list[tuple] = []
            for at in range(0, len(prompts), batch_size):
                scored += _score_rows(scorer, prompts[at : at + batch_size])
            yield pd.DataFrame(scored, columns=[f.name for f in SCORE_FIELDS])

    # Not deterministic for Spark: a filter on the scores must not run the scorer again.
    scorer = F.pandas_udf(run, T.StructType(SCORE_FIELDS)).asNondeterministic()
    scored = rows.withColumn(SCORES, scorer(text)).select(
        *df.columns, *[F.col(f"{SCORES}.{f.name}") for f in SCORE_FIELDS]
    )
    label = F.when(F.col("error").isNull(), label_of_token("decoded_token"))
    return scored.withColumn("classification", label)


def scoring_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks to score so many rows with: all partitions of the session, more if rows ask for it."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def score_once(
    df: DataFrame, text: str, make_scorer: MakeScorer, **options
) -> tuple[DataFrame, DataFrame]:
    """Results and failures of one run of the model, whose scores are written in between.

    Reading ``results`` and ``failures`` of a scored frame one after the other would run it twice.
    """
    spark = df.sparkSession
    path = work_path(spark, "scored")
    scored = score(df, text, make_scorer, **options)
    scored.write.parquet(path)
    saved = spark.read.schema(scored.schema).parquet(path)
    return results(saved), failures(saved)


def results(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("error").isNull()).drop("error")


def failures(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("error").isNotNull()).drop(
        "decoded_token", "prob_0", "prob_1", "classification"
    )


def _saved(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    fields = [*schema.fields, *SCORE_FIELDS, T.StructField("classification", T.IntegerType()),
              T.StructField("saved_at", T.TimestampType()), T.StructField("status", T.StringType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def load_scored(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Results and failures saved for input rows of a schema; failures of several runs are all there."""
    saved = _saved(spark, path, schema).drop("status")
    return results(saved).drop("saved_at"), failures(saved)


def _left(rows: DataFrame, only: DataFrame | None, done: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows of the keys asked for that have no result."""
    for others, how in ((only, "left_semi"), (done, "left_anti")):
        if others is not None:
            rows = rows.join(others, keys, how)
    return rows


def _dealt(
    todo: DataFrame, only: DataFrame | None, done: DataFrame | None, keys: list[str], tasks: int, spread: list[str]
) -> DataFrame:
    """What is left of some rows, dealt to so many tasks.

    If the tasks are no fewer than the session's partitions, and enough for the keys to fit them, rows
    and keys (of the same types) are dealt alike and joined where they land: texts are shuffled once
    and not sorted. If little is left, the joins keep the session's partitions and only what is left
    is dealt to the few tasks.
    """
    others = [x for x in (only, done) if x is not None]
    partitions = int(todo.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    alike = spread == keys and all(x.dtypes == todo.select(*keys).dtypes for x in others)
    if alike and tasks >= partitions and all(x.count() <= tasks * KEYS_PER_TASK for x in others):
        # The hint also keeps adaptive execution from a broadcast, after which it would deal rows anew.
        only, done = (x if x is None else x.repartition(tasks, *keys).hint("shuffle_hash") for x in (only, done))
        return _left(todo.repartition(tasks, *keys), only, done, keys)
    return _left(todo, only, done, keys).repartition(tasks, *spread)


def score_resumable(
    df: DataFrame,
    text: str,
    make_scorer: MakeScorer,
    key: Sequence[str],
    path: str,
    rows_per_save: int = ROWS_PER_SAVE,
    only: DataFrame | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Score rows that have no result under ``path`` yet, each task saving at most about ``rows_per_save``.

    ``key`` names rows for good, such as file name and row number. What is left to do is counted by
    its keys, then dealt by a hash of the key, or of the columns of ``spread_by``, to as many tasks as
    there are amounts to save; one job scores them all. A task's results are in place as soon as it
    ends (version 2 of the file committer), so a run that stops loses the tasks under way, and the
    next run skips whatever is saved. A task that is tried again replaces its own files. Failed rows
    are saved apart and tried again by the next run; of several errors of a row the last one is
    returned. ``only`` holds keys: other rows are left to another run.
    """
    spark = df.sparkSession
    keys = list(key)
    spread = list(options.pop("spread_by", ()))
    todo = df.filter(nonblank(text))
    done = _saved(spark, path, df.schema).filter(F.col("status") == "ok").select(*keys) if exists(spark, path) else None
    only = None if only is None else only.select(*keys)
    count = _left(todo.select(*keys), only, done, keys).count()
    tasks = max(1, -(-count // min(rows_per_save, ROWS_PER_TASK)))
    if spread:
        tasks = max(tasks, scoring_tasks(spark, count))
    rows = _dealt(todo, only, done, keys, tasks, spread or keys).select(*df.columns)
    scored = score(rows, text, make_scorer, **options)
    status = F.when(F.col("error").isNull(), "ok").otherwise("failed")
    (
        scored.withColumns({"saved_at": F.current_timestamp(), "status": status})
        .write.mode("append")
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .option("compression", "zstd")
        .partitionBy("status")
        .parquet(path)
    )
    saved, failed = load_scored(spark, path, df.schema)
    # A row that failed once and then got a result is no failure.
    return saved, pending(keep_last(failed, keys, ["saved_at", "error"]).drop("saved_at"), saved, keys)
