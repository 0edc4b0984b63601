"""Named queries and, where SQL can say the same, their oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
IDS: dict[str, str] = {}


def query(name: str, ids: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the survey rows it covers."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = fn
        IDS[name] = ids
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
