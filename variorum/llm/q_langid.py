"""Query over languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variorum.llm import langid
from variorum.llm.queries import query, table


@query("op4_language_id")
def language_id(spark: SparkSession, sf: str) -> DataFrame:
    """The language of every document by compression, and whether the margin was too narrow to trust."""
    docs, p = table(spark, sf, "documents"), langid.Languages()
    out = langid.classified(docs, langid.learn(docs, p), p)
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), F.col("best").alias("lang_pred"), "score", "rejected")
