"""Month or day ingest: drops to stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..model import KINDS, Kind
from ..operators.keyed import keep_last
from ..operators.quality import RowRule
from ..sources.drops import FILE_ORDER, REFUSED, REJECTS, canonical, scan_kind, sort_out, unreadable
from ..sources.results import upsert_table


def rejects_path(table: str) -> str:
    """Where the refused rows of a table are kept: a folder beside it, with one folder per run."""
    return f"{table.rstrip('/')}_rejects"


def store(
    spark: SparkSession, fine: DataFrame, refused: DataFrame, kind: Kind, table: str, now, run: str | None = None,
    kept: Observation | None = None, rules: Sequence[RowRule] = (),
) -> DataFrame:
    """Upsert rows that were sorted out into a kind's table, and write and return what was refused.

    ``run`` names the folder of these rejects; a run that is repeated under its name replaces them.
    ``kept`` is told the rows of the batch and how many of them break each rule, as it is written.
    """
    path = f"{rejects_path(table)}/run={run or uuid.uuid4().hex}"
    refused.write.mode("overwrite").parquet(path)
    batch = canonical(keep_last(fine, kind.key, FILE_ORDER), kind)
    if kept is not None:
        batch = batch.observe(kept, F.count(F.lit(1)).alias("rows"), *[
            F.count_if(rule.broken()).alias(f"rule {rule.name}") for rule in rules])
    upsert_table(spark, table, batch, kind.table_schema, kind.key, now, kind.defaults)
    return spark.read.schema(REJECTS).parquet(path)


def load_report(seen: dict, kept: dict, files: dict) -> dict[str, int | dict[str, int]]:
    """What became of the rows of a load: those scanned are refused, removed or stored."""
    refused = {name: seen[name] for name in REFUSED}
    before = seen["scanned"] - sum(refused.values())
    return {
        "rows_scanned": seen["scanned"], "rows_refused": sum(refused.values()), "refused": refused,
        "files_unreadable": files["files"], "rows_before": before, "rows_after": kept["rows"],
        "rows_removed": before - kept["rows"],
        "broken": {name[len("rule "):]: n for name, n in kept.items() if name.startswith("rule ")},
    }


def ingest(
    spark: SparkSession, root: str, tables: str, now, kinds: Sequence[str] = tuple(KINDS),
    rules: Mapping[str, Sequence[RowRule]] | None = None, **scan,
) -> dict[str, dict]:
    """Ingest the drops under a folder into ``<tables>/<kind>``, all kinds side by side.

    A kind that fails does not stop the others, and one without files is no failure. Gives, per
    kind, the error, or the rejects: unreadable files, and rows without a date, with a null in the
    key or with a value that does not fit its column. ``report`` says how many rows were scanned,
    refused and for what, removed for a later row of their key, and left, and how many of those
    left break each of the kind's ``rules``. The counts come with the two writes of the load, from
    the tasks that write, so they cost no scan and a repeated task does not count twice.
    """

    def one(name: str) -> dict:
        seen, kept, files = Observation(), Observation(), Observation()
        try:
            scanned, bad = scan_kind(spark, root, name, **scan)
            fine, refused = sort_out(scanned, KINDS[name], seen=seen)
            broken = unreadable(bad).observe(files, F.count(F.lit(1)).alias("files"))
            rejects = store(
                spark, fine, refused.unionByName(broken), KINDS[name], f"{tables}/{name}", now,
                kept=kept, rules=(rules or {}).get(name, ()))
            return {"rejects": rejects, "report": load_report(seen.get, kept.get, files.get), "error": None}
        except Exception as error:  # noqa: BLE001 - reported per kind
            return {"rejects": None, "report": None, "error": str(error)}

    with ThreadPoolExecutor(len(kinds)) as pool:
        return dict(zip(kinds, pool.map(inheritable_thread_target(spark)(one), kinds)))
