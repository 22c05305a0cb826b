"""Every operator as a query over the supplied tables, with the SQL that gives the same rows."""

from . import (  # noqa: F401 - importing registers the queries
    files, joins, keyed, quality, queue, reports, scoring, search, streams, values,
)
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
