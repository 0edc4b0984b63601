"""Words folded as one line are the words folded one by one, and a class of characters is a few ranges."""

import re

from pyspark.sql import functions as F

from variorum.functions import align as A
from variorum.functions import text as T

LINES = [
    ["plain", "words", "don't", "(edge)", "--", "a-b-"], ["ÉCOLE", "ﬁne", "½", "ǅ", "Straße", "北京", "ΣΑΣ"], ["x", "´", "y¨z", "¸", "ﷺ"],
    ["'", "''", "!", "ok"], ["\u0001", "a"], ["—"], [], None, ["İstanbul", "“quoted”", "…", "№5", "㎏"],
]


def test_a_line_folds_as_its_words(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LINES)], "i int, w array<string>")
    by_word = df.select("i", F.array_join(F.transform("w", lambda x: F.coalesce(F.nullif(T.fold_strong(x), F.lit("")), F.lit(T.EMPTY_FOLD))), " ").alias("n"))
    got = {r.i: r.n for r in df.select("i", T.fold_strong_line(F.col("w")).alias("n")).collect()}
    assert got == {r.i: r.n for r in by_word.collect()}
    pairs = df.alias("a").crossJoin(df.alias("b")).select(F.col("a.w").alias("a"), F.col("b.w").alias("b"))
    norms = lambda c: F.filter(F.transform(c, T.fold_strong), lambda x: x != "")
    rows = pairs.select(A.texts_match(F.col("a"), F.col("b")).alias("got"), (norms("a") == norms("b")).alias("want")).collect()
    assert len(rows) == len(LINES) ** 2 and all(r.got == r.want for r in rows)


def test_classes_are_ranges():
    for pattern, chars in ((T._NFKD_LONG, {c for c, _ in T._NFKD_MULTI}), (T._BLANKS, {c for c, d in (*zip(T._NFKD_SRC, T._NFKD_DST), *T._NFKD_MULTI) if " " in d})):
        assert len(pattern) < max(100, len(chars) / 2)
        every = (chr(c) for c in range(0x30000) if not 0xD800 <= c <= 0xDFFF)
        assert {c for c in every if re.match(pattern, c)} == {c for c in chars if ord(c) < 0x30000}
