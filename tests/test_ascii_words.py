"""Words of a whole text at once are those of its lines one by one."""

from pyspark.sql import functions as F

from variorum.functions import text as T

TEXTS = [
    None, "", "\n\n", "# Heading\nplain words", "##\nabc", "#'abc' d'e\r\n[note that\nends] here", "[x]#été—naïve–ok 'tis", "a [" + "y" * 81 + "] b [z] c",
    "K Ünder “quoted” 12ab ab12 o'clock'\n37\n  trimmed  \n— –\n☃ snow", "one\rtwo [a\rb] three",
]


def test_words_of_all_lines_at_once(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    noise = r"^\d+$"
    lines = F.filter(F.transform(F.split("text", r"\r?\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.rlike(noise))
    by_line = F.flatten(F.transform(lines, lambda x: T.line_words(x, 80)))
    got = T.tokens_ascii(F.col("text"), noise, 80)
    for r in rows.select("id", by_line.alias("a"), got.alias("b")).collect():
        assert r.a == r.b, TEXTS[r.id]
    # one search for words per text, not per line
    assert str(got).startswith("Column<'regexp_extract_all(")
