"""Query over the main text of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variorum.llm import pagetext
from variorum.llm.queries import query, table


@query("op13_html_extraction")
def html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of every page."""
    return pagetext.extracted(table(spark, sf, "pages"))
