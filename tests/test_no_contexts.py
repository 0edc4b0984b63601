"""Queries that return no contexts do not make them in the row of every disagreement."""

import pytest

from variorum.plans import load


@pytest.mark.parametrize("name", ["rule_linebreaks", "rule_formats", "rule_fourth_reading", "uncertainty_appendix", "uncertainty_index", "uncertain_pages"])
def test_no_contexts_made(spark, tmp_path, name):
    schema = {"documents": "doc_id long, text string, lang string, source string, n_chars long"}
    for table, columns in schema.items():
        spark.createDataFrame([(1, "One line of text\nand another of it", "en", "a", 35)], columns).write.parquet(f"{tmp_path}/{table}.parquet")
    plan = load().QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "left_ctx" not in plan and "q_span" in plan
