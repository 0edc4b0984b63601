"""Bucketed scans equal plain windows, whatever the bucket width."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from variorum.operators import ordered


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.7 else f"g{i % 3}", i, rng.randint(0, 9) if rng.random() < 0.5 else None, rng.random() < 0.7, rng.random() < 0.6) for i in range(200)]
    return spark.createDataFrame(data, "g string, k long, v int, f boolean, c boolean")


@pytest.mark.parametrize("width", [1, 7, 64, 10_000])
def test_scans(rows, width):
    w = Window.partitionBy("g").orderBy("k")
    df = ordered.with_bucket(rows, "k", width)
    df = ordered.running_sum(df, ["g"], ["k"], F.coalesce("v", F.lit(0)), "s", "bucket")
    df = ordered.row_number(df, ["g"], ["k"], "rn", "bucket")
    df = ordered.fill_forward(df, ["g"], ["k"], F.col("v"), "ff", "bucket")
    df = ordered.running_max(df, ["g"], ["k"], F.col("v"), "mx", "bucket")
    df = ordered.neighbour(df, ["g"], ["k"], ["k"], "nx", "bucket")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    df = (
        df.withColumn("s0", F.coalesce(F.sum(F.coalesce("v", F.lit(0))).over(before), F.lit(0))).withColumn("rn0", F.row_number().over(w))
        .withColumn("ff0", F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("mx0", F.max("v").over(before)).withColumn("nx0", F.lead("k").over(w))
    )
    out = df.collect()
    assert len(out) == 200
    for r in out:
        assert (r.s, r.rn, r.ff, r.mx, r.nx.k if r.nx else None) == (r.s0, r.rn0, r.ff0, r.mx0, r.nx0)


@pytest.mark.parametrize("width", [None, 5])
def test_alternate_chain(rows, width):
    df = ordered.with_bucket(rows, "k", width) if width else rows
    got = {(r.g, r.k): r.m for r in ordered.alternate_chain(df, ["g"], ["k"], F.col("f"), F.col("c"), "m", "bucket" if width else None).collect()}
    last: dict[str, bool] = {}
    for r in sorted(rows.collect(), key=lambda r: r.k):
        last[r.g] = r.f and not (r.c and last.get(r.g, False))
        assert got[(r.g, r.k)] == last[r.g]


def test_global_rank(spark):


    rows = [(i * 7919 % 1000, "x" if i % 3 else None) for i in range(1000)] + [(5, "y")] * 20
    df = spark.createDataFrame(rows, "a int, b string").repartition(6)
    got = [(r["a"], r["b"]) for r in sorted(ordered.global_rank(df, [F.col("b").desc_nulls_last(), F.col("a")], "n").collect(), key=lambda r: r["n"])]
    assert got == sorted(got, key=lambda r: (r[1] is None, {"y": 0, "x": 1}.get(r[1]), r[0])) and len(got) == len(rows)
    assert sorted(r["n"] for r in ordered.global_rank(df, [F.col("a")], "n").collect()) == list(range(1, len(rows) + 1))
    assert ordered.global_rank(df.limit(0), [F.col("a")], "n").isEmpty()
