"""Blocks of a long text travel as strings and give back every word."""

from variorum.operators import longdiff


def test_blocks_are_lines(spark):
    words = [f"w{i}" for i in range(50)]
    rows = [("a", k, words[10 * k : 10 * k + 10]) for k in range(5)] + [("b", 0, ["x", "", "y"]), ("b", 1, [])]
    p = longdiff.Long(block=8)
    laid = longdiff.blocks(longdiff.stream(spark.createDataFrame(rows, "side string, part_no int, words array<string>"), [], "part_no"), [], p, 3)
    assert dict(laid.dtypes)["line"] == "string"
    got = {(r.side, r.block): r.line.split(" ") for r in laid.collect()}
    assert got[("b", 0)] == ["x", "", "y"]
    for block in range(7):
        assert got[("a", block)] == words[8 * block : 8 * block + 8 + 3]
