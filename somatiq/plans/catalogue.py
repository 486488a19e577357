"""All queries of the library by name, with the SQL that gives the same rows where SQL can.

The driver's tables stand for the data model: a user of ``events`` is a file, ``value`` its signal
or NN interval, ``view`` and ``purchase`` begin and end a visit. Each query runs over its whole
tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


from . import event_queries, signal_queries, table_queries  # noqa: E402, F401
