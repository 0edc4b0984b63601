"""Queries over books whose sources share one page numbering; eight documents are the sources of a book."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variorum.operators import assemble, numbering
from variorum.plans.assembly_queries import SQL_BLOCKS, SQL_PAGES, unit_blocks
from variorum.plans.corpus import sql
from variorum.plans.line_queries import kinds
from variorum.plans.registry import query

BOOK = ("doc_id",)


def arrivals(spark, sf) -> DataFrame:
    """book, source_rank, doc_id, unit_no, seg, kind, page_number, needs_review of every page, unmarked content and failed block."""
    blocks = unit_blocks(spark, sf)
    failed = F.col("type") == "needs_review"
    here = ["doc_id", "unit_no", F.col("seg").cast("int").alias("seg")]
    none = F.lit(None).cast("int").alias("page_number")
    poor = blocks.filter(failed & F.col("page_number").isNotNull()).select(*here, F.lit(True).alias("needs_review")).distinct()
    starts = assemble.page_starts(kinds(spark, sf), BOOK).select(*here, F.lit(numbering.PAGE).alias("kind"), "page_number")
    marked = starts.join(poor, ["doc_id", "unit_no", "seg"], "left").withColumn("needs_review", F.coalesce("needs_review", F.lit(False)))
    loose = blocks.filter(~failed & F.col("page_number").isNull()).select(*here, F.lit(numbering.ORPHAN).alias("kind"), none, F.lit(False).alias("needs_review")).distinct()
    # failed blocks come before the content that they interrupt
    items = blocks.filter(failed & F.col("page_number").isNull()).select("doc_id", "unit_no", (F.col("at") - 1_000_000).alias("seg"), F.lit(numbering.REVIEW).alias("kind"), none, F.lit(True).alias("needs_review"))
    every = marked.unionByName(loose).unionByName(items)
    book = F.floor(F.col("doc_id") / F.lit(8.0)).cast("long")
    return every.withColumn("book", book).withColumn("source_rank", (F.col("doc_id") * 5 % 8).cast("int"))


_WALK = """
arr AS (SELECT doc_id // 8 AS book, CAST(doc_id * 5 % 8 AS INTEGER) AS source_rank, * FROM (
  SELECT s.doc_id, s.unit_no, s.seg, 'page' AS kind, s.page_number,
    EXISTS (SELECT 1 FROM blocks b WHERE b.doc_id = s.doc_id AND b.unit_no = s.unit_no AND b.seg = s.seg AND b.page_number IS NOT NULL AND b.type = 'needs_review') AS needs_review FROM starts s
  UNION ALL SELECT DISTINCT doc_id, unit_no, seg, 'orphan', NULL::INTEGER, false FROM blocks WHERE page_number IS NULL AND type <> 'needs_review'
  UNION ALL SELECT doc_id, unit_no, pos - 1000000, 'review', NULL, true FROM blocks WHERE page_number IS NULL AND type = 'needs_review')),
seqd AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY book ORDER BY source_rank, unit_no, seg) AS i FROM arr),
walk AS (SELECT DISTINCT book, 0::BIGINT AS i, []::BIGINT[] AS taken, -1 AS source_rank, 0::BIGINT AS last, 0::BIGINT AS highest, 0::BIGINT AS before, NULL::BIGINT AS number FROM seqd
  UNION ALL SELECT book, i, CASE WHEN num IS NULL THEN taken ELSE list_append(taken, num) END, source_rank, CASE WHEN num IS NULL THEN l WHEN kind = 'orphan' THEN num ELSE greatest(l, num) END,
    CASE WHEN num IS NULL THEN highest ELSE greatest(highest, num) END, highest, num FROM (
    SELECT *, CASE kind WHEN 'page' THEN CASE WHEN NOT list_contains(taken, page_number::BIGINT) THEN page_number::BIGINT END
      WHEN 'orphan' THEN list_min(list_filter(range(l + 2, l + 3 + len(taken)), lambda x: NOT list_contains(taken, x))) END AS num FROM (
      SELECT s.book, s.i, s.source_rank, s.kind, s.page_number, w.taken, w.highest, CASE WHEN s.source_rank <> w.source_rank THEN 0 ELSE w.last END AS l
      FROM walk w JOIN seqd s ON s.book = w.book AND s.i = w.i + 1))),
placed AS (SELECT s.*, w.number, w.before FROM seqd s JOIN walk w ON w.book = s.book AND w.i = s.i)"""


def _recursive(select: str) -> str:
    return sql(*SQL_BLOCKS, SQL_PAGES[0], _WALK.strip(), select=select).replace("WITH ", "WITH RECURSIVE ", 1)


@query("shared_numbering", "W8 W9 O1", _recursive("""
SELECT book, source_rank, doc_id, unit_no, seg, kind, number, kind = 'orphan' AS inferred, kind = 'page' AND number IS NULL AS duplicate FROM placed"""))
def _(spark, sf):
    """The number of every page and of all unmarked content, when eight documents share one numbering."""
    rows = numbering.shared_numbers(arrivals(spark, sf), ["book"])
    return rows.select("book", "source_rank", "doc_id", "unit_no", "seg", "kind", "number", "inferred", "duplicate")


@query("shared_review_items", "U8 O1", _recursive("""
SELECT book, source_rank, doc_id, unit_no, seg, (CASE kind WHEN 'review' THEN before + 1 ELSE page_number END)::VARCHAR AS estimated FROM placed WHERE needs_review"""))
def _(spark, sf):
    """One row per failed block without a page, and one per page that holds failed blocks, with the pages it probably covers."""
    rows = numbering.estimated_pages(numbering.shared_numbers(arrivals(spark, sf), ["book"]))
    return rows.select("book", "source_rank", "doc_id", "unit_no", "seg", F.array_join(F.transform("estimated_pages", lambda x: x.cast("string")), ",").alias("estimated"))
