"""Queries over whole reports: one order and one numbering over all books, and shares of good pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from variorum.operators import ordered, score
from variorum.plans.align_sql import PAGES, recursive
from variorum.plans.corpus import PARAMS, SQL_LINES, documents, lines, pages, sql, sql_pages
from variorum.plans.registry import query

BOOK = ("doc_id",)


@query("page_report_order", "W18 O1 O2 O3", sql(SQL_LINES, sql_pages("lines", "p"), """
rk AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) AS source_rank FROM documents GROUP BY source)""", select="""
SELECT row_number() OVER (ORDER BY source_rank, length(text) > 400 DESC, doc_id, page_number) AS report_no, doc_id, page_number, source_rank::BIGINT AS source_rank, length(text) > 400 AS is_long
FROM p JOIN rk ON rk.source IS NOT DISTINCT FROM p.source"""))
def _(spark, sf):
    """All pages in one numbered report: sources by how many documents they have, long pages first, then in order."""
    ranks = ordered.global_rank(documents(spark, sf).groupBy("source").agg(F.count("*").alias("n")), [F.col("n").desc(), F.col("source")], "source_rank").drop("n")
    rows = pages(spark, sf).alias("p").join(ranks.alias("r"), F.col("p.source").eqNullSafe(F.col("r.source"))).select("p.doc_id", "p.page_number", "p.text", "r.source_rank")
    rows = rows.select("doc_id", "page_number", "source_rank", (F.length("text") > 400).alias("is_long"))
    return ordered.global_rank(rows, [F.col("source_rank"), F.col("is_long").desc(), F.col("doc_id"), F.col("page_number")], "report_no")


@query("marked_lines_report", "O4 W18 T3", sql(SQL_LINES, """
hit AS (SELECT doc_id, line_no, 'doubled_blank' AS issue FROM lines WHERE contains(line, '  ')
  UNION ALL SELECT doc_id, line_no, 'short_line' FROM lines WHERE length(trim(line)) BETWEEN 1 AND 20
  UNION ALL SELECT doc_id, line_no, 'empty_line' FROM lines WHERE trim(line) = '')""", select="""
SELECT row_number() OVER (ORDER BY doc_id, line_no, issue) AS report_no, doc_id, line_no, issue FROM hit"""))
def _(spark, sf):
    """Issues of several kinds in one report, by document, line and kind, with gapless numbers."""
    rows = lines(spark, sf)
    trimmed = F.trim("line")
    kinds = {"doubled_blank": F.col("line").contains("  "), "short_line": F.length(trimmed).between(1, 20), "empty_line": trimmed == ""}
    found = F.array_compact(F.array(*(F.when(test, F.lit(kind)) for kind, test in kinds.items())))
    issues = rows.select("doc_id", "line_no", F.explode(found).alias("issue"))
    return ordered.global_rank(issues, [F.col("doc_id"), F.col("line_no"), F.col("issue")], "report_no")


@query("page_good_share", "G2", recursive(*PAGES, select="""
SELECT doc_id, count(*) AS n_comparable, 100.0 * count(*) FILTER (len(w1) = 0 AND len(w2) = 0 OR r >= 0.92) / count(*) AS pct_good
FROM (SELECT pw.*, CASE WHEN len(w1) > 0 AND len(w2) > 0 THEN 2.0 * coalesce(n, 0) / (len(w1) + len(w2)) END AS r FROM pw LEFT JOIN (SELECT k, sum(n) AS n FROM pg_mb GROUP BY k) USING (k)) GROUP BY doc_id"""))
def _(spark, sf):
    """Of every document's pages that two readings have, the percentage on which they agree."""
    rows = score.compare_pages(pages(spark, sf, "q", moving=True), pages(spark, sf, "m", moving=True), BOOK, PARAMS)
    return score.good_share(rows, BOOK)
