"""The files of a mix hold its text twice, in parts and whole, so they are packed closely."""

from pathlib import Path

import pyarrow.parquet as pq

from variorum.llm import mixing


def test_mix_files_are_packed(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i} and more of it " * 20, "ab"[i % 2]) for i in range(20)], "doc_id long, text string, source string")
    out = tmp_path / "mix"
    rows = mixing.mix(docs, out=str(out)).collect()
    files = [pq.ParquetFile(f).metadata for f in Path(out).glob("*.parquet")]
    groups = [f.row_group(i) for f in files for i in range(f.num_row_groups)]
    assert groups and all(g.column(c).compression == "ZSTD" for g in groups for c in range(g.num_columns))
    whole = spark.read.parquet(str(out)).collect()
    assert sum(p["n"] for r in whole for p in r["parts"]) == sum(r["taken"] for r in rows) > 0
    assert all(r["text"] == "\n".join(p["text"] for p in r["parts"]) for r in whole)
