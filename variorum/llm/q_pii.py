"""Query over personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variorum.llm import pii
from variorum.llm.queries import query, table

# a caller has a secret; the queries need one that everybody knows
KEY = b"the key of the registered queries"


@query("op3_pii_pseudonyms")
def pii_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's text with pseudonyms, and how many values of each kind it held."""
    out = pii.pseudonyms(table(spark, sf, "documents"), KEY)
    return out.select("doc_id", "text", *(f"n_{k}" for k in pii.KINDS))
