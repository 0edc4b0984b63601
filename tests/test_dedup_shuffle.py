"""Pages are dealt as they are; token sets and tails made of them are not shuffled, and unchanged pages are not kept twice."""

from variorum.operators import dedup
from variorum.params import DEFAULT


def test_pages_are_dealt_bare_and_kept_once(spark):
    words = " ".join(f"word{chr(97 + i)}" for i in range(20))
    other = " ".join(f"thing{chr(97 + i)}" for i in range(20))
    rows = [(b, i, i, [("paragraph", words if i % 4 == 0 else f"{other} {'xyz'[i % 3]}" * (i % 3))]) for b in range(3) for i in range(12)]
    df = spark.createDataFrame(rows, "book long, page_rank long, _idx long, orig array<struct<type string, text string>>")
    alone = dedup._alone(df, ["book"], DEFAULT, 256)
    plan = alone._jdf.queryExecution().sparkPlan().toString(), alone._jdf.queryExecution().executedPlan().toString()
    assert plan[1].count("Exchange") == 1
    got = alone.collect()
    assert len(got) == len(rows) and any(r.changed for r in got) and not all(r.changed for r in got)
    assert all((r.new is not None and r.new != r.orig) == r.changed for r in got)
