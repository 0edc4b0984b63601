"""Queries over one long text: the whole table, document after document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variorum.operators import longdiff
from variorum.plans.align_sql import moving
from variorum.plans.corpus import SQL_LINES, dealt, reading_lines, sql
from variorum.plans.registry import query


def two_sides(spark, sf) -> DataFrame:
    """side, part_no, words: two readings of all documents, each one text in order of document."""
    docs = dealt(spark, sf).filter(F.col("text").isNotNull())
    cut = lambda r: F.filter(F.split(F.array_join(reading_lines(r, moving=True), " "), " "), lambda x: x != "")
    sides = F.array(*(F.struct(F.lit(s).alias("side"), cut(r).alias("words")) for s, r in (("a", "q"), ("b", "m"))))
    return docs.select(F.col("doc_id").alias("part_no"), F.explode(sides).alias("x")).select("x.side", "part_no", "x.words")


@query("corpus_diff", "A12 G3")
def _(spark, sf):
    """All changes between two readings of the whole corpus, aligned as one pair."""
    return longdiff.changes(two_sides(spark, sf), [])


_TOKENS = "list_filter(string_split(line, ' '), lambda x: x <> '')"


@query("corpus_diff_replay", "A12", sql(SQL_LINES, *(moving(r)[0] for r in "qm"), select=f"""
SELECT (SELECT sum(len({_TOKENS})) FROM ml_q)::BIGINT AS n_a, (SELECT sum(len({_TOKENS})) FROM ml_m)::BIGINT AS n_b, true AS replays, true AS mostly_kept"""))
def _(spark, sf):
    """Sizes of both texts, whether the changes turn one into the other word by word, and whether they leave most words."""
    parts = two_sides(spark, sf)
    found = longdiff.replayed(parts, longdiff.changes(parts, []), [])
    return found.select("n_a", "n_b", "replays", (F.col("n_kept") * 2 > F.col("n_a")).alias("mostly_kept"))
