"""Queries over near-duplicate documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variorum.llm import minhash, sqltext
from variorum.llm.queries import query, table

NEAR_SQL = f"""WITH RECURSIVE {sqltext.near_groups("documents", 2, 80)}
SELECT doc_id, n AS n_shingles, component AS component_id, doc_id = component AS kept FROM placed"""


@query("op1_minhash_near_dedup", NEAR_SQL)
def near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's component under two-word shingles at a similarity of 0.8."""
    return minhash.near_duplicates(table(spark, sf, "documents"), params=minhash.MinHash(shingle=2))
