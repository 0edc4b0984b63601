"""The registered queries over these operators and, where SQL can say the same, their oracles."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_MODULES = ("q_dedup", "q_quality", "q_mixing", "q_pii", "q_decontaminate", "q_substrings", "q_secrets", "q_urls", "q_langid", "q_licenses", "q_pagetext", "q_tokens", "q_phrases")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its oracle if there is one."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for name in _MODULES:
        import_module(f"variorum.llm.{name}")
    return QUERIES, ORACLES
