import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from dayfold.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def frame(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
