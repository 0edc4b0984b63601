"""The pipeline's stages on the smallest table, each against the operator's plain meaning."""

import re

import pytest

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return [{r["doc_id"]: r for r in df.collect()} for df in out], [df.columns for df in out]


def test_columns(stages):
    _, columns = stages
    assert all(tuple(c) == pipeline.COLUMNS for c in columns[:-1]) and columns[-1][-4:] == ["size", "source_size", "target", "taken"]


def test_each_stage_works_on_what_was_kept(stages, spark):
    (docs, good, unlike, unseen, private, mixed), _ = stages
    assert set(docs) > set(good) > set(unlike) >= set(unseen) and set(unseen) == set(private) == set(mixed)
    sets = {i: {tuple(w[k : k + 5]) for w in [r["text"].lower().split()] for k in range(len(w) - 4)} for i, r in good.items()}
    for i in set(good) - set(unlike):  # a removed document has a chain of near copies to a kept, smaller one
        group, grown = {i}, True
        while grown:
            more = {b for a in group for b in sets if b not in group and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
            group, grown = group | more, bool(more)
        assert min(group) < i and min(group) in unlike
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(unlike) - set(unseen) >= {i for i, r in unlike.items() if any(t in r["text"] for t in items)}
    assert not any(re.search(r"@mail\d\.example", r["text"]) for r in private.values())
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in mixed.values())


def test_run(spark, stages):
    got = pipeline.run(spark, SF)
    assert {r["doc_id"]: r["taken"] for r in got.collect()} == {i: r["taken"] for i, r in stages[0][-1].items()}
