"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings a job should run with on any cluster. Adaptive execution merges shuffle
# partitions up to the advisory size but never makes more than the number set, so jobs raise that
# number with their input (``scale_to``). The bound on Arrow batches keeps rows with long texts from
# filling a Python worker.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Give a running session the recommended settings.

    What the cluster was started with stays, but for the time zone, on which results depend: its
    sizes fit its executors.
    """
    given = spark.sparkContext.getConf()
    for name, value in RECOMMENDED.items():
        if name == "spark.sql.session.timeZone" or not given.contains(name):
            spark.conf.set(name, value)
    return spark


# Input bytes per shuffle partition, and the most partitions a job asks for.
BYTES_PER_PARTITION = 128 << 20
MOST_PARTITIONS = 200_000


def partitions_for(size: int, least: int = 1) -> int:
    """Shuffle partitions for so many bytes of input."""
    return min(MOST_PARTITIONS, max(least, -(-size // BYTES_PER_PARTITION)))


def scale_to(spark: SparkSession, size: int) -> int:
    """Raise the session's number of shuffle partitions to what the input needs; never lower it.

    Results do not depend on it.
    """
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = partitions_for(size, now)
    if needed > now:
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    return needed


def local_session(cores: int | str = "*", app: str = "dayfold", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **RECOMMENDED,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **extra,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder. On a
    cluster a machine-local folder would lose data with its machine, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="dayfold-")
    spark.conf.set("spark.checkpoint.dir", made)
    spark.sparkContext.setCheckpointDir(made)
    return made


def work_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
