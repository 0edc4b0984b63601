"""Queries over the mix of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variorum.llm import mixing
from variorum.llm.queries import query, table


@query("op7_mix_sources")
def mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mix(table(spark, sf, "documents"))


@query("op7_mixture")
def mixture(spark: SparkSession, sf: str) -> DataFrame:
    """The mix itself: the text of every slot of the output shards."""
    return mixing.mixture(table(spark, sf, "documents")).select("shard", "turn", "sid", "block", "text")
