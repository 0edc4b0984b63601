"""Pages are transplanted with one alignment of each pair of texts, folded where it is made."""

import pytest
from pyspark.sql import functions as F

from variorum.functions import text as T
from variorum.plans import load

SF = "/root/testdata/sf0.001"


def _aligning(df) -> int:
    """Steps of the plan that run the matcher."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    return sum("ArrowEvalPython" in x and "opcodes" in x for x in lines)


def test_base_transplant_aligns_once(spark):
    df = load().QUERIES["base_transplant"](spark, SF)
    assert _aligning(df) == 1


@pytest.mark.parametrize("text", ["Él DIJO ñandú", "İstanbul 北京 ß", "", "a — b"])
def test_folding_where_words_are_compared_keeps_opcodes(spark, text):
    from variorum.functions import align as A

    other = "el dijo nandu istanbul x"
    row = spark.createDataFrame([(text, other)], "a string, b string")
    folded = A.opcodes(T.fold_keeping_tokens(F.col("a")), T.fold_keeping_tokens(F.col("b")))
    got = row.select(folded.alias("x"), A.opcodes_folded(F.col("a"), F.col("b")).alias("y")).first()
    assert got.x == got.y
