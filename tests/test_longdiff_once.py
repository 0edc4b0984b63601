"""What a long diff asks for is made once: the words of its parts, and the cut of a stretch into words."""

from pyspark.sql import functions as F

from variorum.operators import longdiff


def test_parts_are_made_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def words(line):
        seen.add(1)
        return line.split(" ")

    rows = [(s, n, f"{s if n % 3 == 0 else 'w'}{n} x{n} y{n}") for s in "ab" for n in range(20)]
    parts = spark.createDataFrame(rows, "side string, part_no int, line string").select("side", "part_no", words("line").alias("words"))
    found = longdiff.changes(parts, [])
    assert found.count() == 7 and seen.value == len(rows)
    assert longdiff.replayed(parts, found, []).first().replays
    assert seen.value == 2 * len(rows)


def test_words_are_not_cut_per_change(spark):
    rows = [("a", 0, ["x", "y", "z"]), ("b", 0, ["x", "q", "z"])]
    found = longdiff.changes(spark.createDataFrame(rows, "side string, part_no int, words array<string>"), [])
    assert [tuple(r) for r in found.collect()] == [(1, 2, 1, 2, "replace", "y", "q")]
    steps = [x for x in found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines() if "split(_a" in x]
    assert steps and all("Generate " in x for x in steps)
