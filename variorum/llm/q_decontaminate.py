"""Query over benchmark leaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variorum.llm import decontaminate
from variorum.llm.queries import query, table


@query("op5_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and how much of it."""
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
