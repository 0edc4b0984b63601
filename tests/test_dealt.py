"""Readings are made by as many tasks as there are, however few row groups the documents' file has."""

from variorum.plans import corpus
from variorum.plans.diff_queries import _two_generations


def test_readings_are_made_by_all_tasks(spark, tmp_path):
    rows = [(i, f"s{i % 3}", "en", "\n".join(f"line {j} of text {i}" for j in range(7))) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = [corpus.pages(spark, str(tmp_path), "q", True), corpus.units(spark, str(tmp_path), "m", True), corpus.structured_units(spark, str(tmp_path)), _two_generations(spark, str(tmp_path))]
    for df in made:
        assert df.rdd.getNumPartitions() == n
        assert df.select("doc_id").distinct().count() == len(rows)
