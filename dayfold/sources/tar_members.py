"""Members of tar archives as a data source.

After ``register(spark)``, ``spark.read.format("tar_members").load(folder)`` has a row per member:
``archive, member, size, content, error``. Options:

* ``content``: ``true`` to have the bytes of the members; the column is absent otherwise
* ``recursive``: ``false`` to leave out subfolders
* ``broken``: ``fail`` (as it stands) stops at an archive that cannot be read to its end; ``report``
  gives one row with its ``error`` in place of its members, and reads each archive once more
  beforehand to know
* ``partitionBytes``: small archives share a task up to so many bytes; a larger one has its own

A condition on the end of ``member`` is pushed down, so other members are not unpacked, and one on
whole values of ``archive`` as well, so other archives are not opened. Spark applies both again.
"""

from __future__ import annotations

import tarfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringEndsWith
from pyspark.sql.types import StructType

from .drops import open_file

ARCHIVES = (".tar", ".tar.gz", ".tar.xz")
PARTITION_BYTES = 128 << 20
# A batch of rows is handed over when it has so many bytes of content or so many rows.
BATCH_BYTES = 16 << 20
BATCH_ROWS = 10_000

_TYPES = {"archive": pa.string(), "member": pa.string(), "size": pa.int64(), "content": pa.binary(), "error": pa.string()}


def register(spark: SparkSession) -> None:
    """Make the source known to a session, and let Spark push conditions down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TarMembers)


@dataclass
class Archives(InputPartition):
    paths: list[str]


class TarMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tar_members"

    def schema(self) -> str:
        content = "content binary, " if self.options.get("content", "false").lower() == "true" else ""
        return f"archive string, member string, size long, {content}error string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return TarMembersReader(dict(self.options.items()), schema.fieldNames())


class TarMembersReader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]) -> None:
        given = {k.lower(): v for k, v in options.items()}
        if "path" not in given:
            raise ValueError("tar_members needs the folder of the archives")
        self.root = given["path"]
        self.recursive = given.get("recursive", "true").lower() == "true"
        self.broken = given.get("broken", "fail").lower()
        if self.broken not in ("fail", "report"):
            raise ValueError(f"broken is fail or report: {self.broken!r}")
        self.partition_bytes = int(given.get("partitionbytes", PARTITION_BYTES))
        self.columns = columns
        self.suffixes: list[str] = []
        self.archives: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Use conditions on the end of the member's name and on the archive; leave all to Spark too.

        A row that reports an archive has no member, so Spark's own check drops it as it should.
        """
        for condition in filters:
            if isinstance(condition, StringEndsWith) and condition.attribute == ("member",):
                self.suffixes.append(condition.value)
            elif isinstance(condition, (EqualTo, In)) and condition.attribute == ("archive",):
                named = {condition.value} if isinstance(condition, EqualTo) else set(condition.value)
                self.archives = named if self.archives is None else self.archives & named
            yield condition

    def partitions(self) -> list[Archives]:
        """Archives in order of their path, packed up to the size of a partition."""
        system, folder = open_file(self.root)
        # Paths are told as they were given: the root, and what comes below it.
        root = self.root.rstrip("/")
        found = sorted(
            (root + info.path[len(folder.rstrip("/")):], info.size)
            for info in system.get_file_info(fs.FileSelector(folder, recursive=self.recursive))
            if info.is_file and info.base_name.endswith(ARCHIVES))
        packed: list[Archives] = []
        room = 0
        for path, size in found:
            if self.archives is not None and path not in self.archives:
                continue
            if not packed or size > room:
                packed.append(Archives([]))
                room = self.partition_bytes
            packed[-1].paths.append(path)
            room -= size
        return packed or [Archives([])]  # Spark takes no partitions at all for one without a description

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            if self.broken == "report":
                try:
                    for _ in _members(path):
                        pass
                except Exception as error:  # noqa: BLE001 - reported in place of the members
                    yield self._batch([{"archive": path, "error": f"{type(error).__name__}: {error}"}])
                    continue
            yield from self._batches(path)

    def _batches(self, path: str) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        held = 0
        for info, tar in _members(path):
            if not all(info.name.endswith(s) for s in self.suffixes):
                continue
            row = {"archive": path, "member": info.name, "size": info.size}
            if "content" in self.columns:
                row["content"] = tar.extractfile(info).read()
                held += info.size
            rows.append(row)
            if held > BATCH_BYTES or len(rows) >= BATCH_ROWS:
                yield self._batch(rows)
                rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {c: pa.array([r.get(c) for r in rows], _TYPES[c]) for c in self.columns})


def _members(path: str) -> Iterator[tuple[tarfile.TarInfo, tarfile.TarFile]]:
    """Files of an archive in its order; it is streamed, so it may be larger than memory."""
    system, name = open_file(path)
    with system.open_input_stream(name, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
        for info in tar:
            if info.isfile():
                yield info, tar
