"""Query over the tokens of two vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variorum.llm import tokens
from variorum.llm.queries import query, table


@query("op11_token_alignment")
def token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Where the byte-level and the piece tokens of every document end together, and how usual its links are."""
    return tokens.alignment(table(spark, sf, "documents"))
