"""Readings and base of a unit are put together by one shuffle of lines; what a unit covers decides its base."""

import re

from variorum.operators import spans
from variorum.params import Params
from variorum.plans.diff_queries import aligned

WORDS = "one two three four five six seven eight"


def _aligned(spark, **kw):
    unit = "book string, unit_no int, content string"
    q = spark.createDataFrame([("b", 1, f"[Page 1]\n{WORDS}\n[Page 2]\nx y"), ("b", 2, f"{WORDS} q"), ("b", 3, "only here"), (None, 1, WORDS), ("b", 5, "no page")], unit)
    m = spark.createDataFrame([("b", 1, f"[Page 9]\n{WORDS}\nx z"), ("b", 2, f"[Page 2]\n{WORDS}"), ("b", 4, "only there"), (None, 1, WORDS), ("b", 5, "no page")], unit)
    base = spark.createDataFrame([("b", 1, "base one"), ("b", 2, "base two"), ("b", 9, "base nine"), ("c", 1, "other")], "book string, page_number int, text string")
    return spans.aligned(q, m, base, params=Params(), **kw)


def test_units_and_their_base(spark):
    got = {r.unit_no: (r.pages, r.c) for r in _aligned(spark).collect()}
    assert got == {1: ([1, 2], ["base", "one", "base", "two"]), 2: ([2], ["base", "two"]), 5: ([], [])}
    assert {r.unit_no for r in _aligned(spark, keep_unpaged=False).collect()} == {1, 2}


def test_lines_are_shuffled_once(spark):
    plan = aligned(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"\bJoin ", plan)
    # documents for each reading, and the units
    assert len(re.findall("RepartitionByExpression", plan)) == 6
