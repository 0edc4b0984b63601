"""From lines to blocks, pages and chapters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from variorum.functions import predicates as P
from variorum.functions import text as T
from variorum.operators import assemble, ordered, qa
from variorum.plans.corpus import PARAMS, SQL_KINDS, SQL_LINES, SQL_STRUCTURED, documents, lines, pages, sql, sql_pages, structured_units
from variorum.plans.line_queries import kinds
from variorum.plans.registry import query
from variorum.sources import paged

BOOK = ("doc_id",)

# paragraphs and other blocks of every unit, before neighbours inside a sentence are merged
_SQL_BLOCKS0 = """
u0 AS (SELECT *, max(CASE WHEN pos = 0 AND regexp_matches(line, '\\[(?:NEEDS_REVIEW|EXTRACTION_ERROR)') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, unit_no) AS failed FROM s_kinds),
u1 AS (SELECT doc_id, unit_no, pos, line, CASE WHEN failed = 1 THEN 'needs_review' ELSE kind END AS kind, chapter, failed FROM u0 WHERE failed = 0 OR pos = 0),
u2 AS (SELECT *, CAST(sum(CASE WHEN kind = 'page_marker' THEN 1 ELSE 0 END) OVER w AS INTEGER) AS seg,
  last_value(CASE WHEN kind = 'page_marker' THEN CAST(regexp_extract(line, '(\\d+)', 1) AS INTEGER) END IGNORE NULLS) OVER w AS page_number,
  sum(CASE WHEN kind IN ('blank', 'page_marker', 'chapter_heading', 'bare_number', 'section_break', 'section_number', 'italic_block', 'needs_review') THEN 1 ELSE 0 END) OVER w AS grp
  FROM u1 WINDOW w AS (PARTITION BY doc_id, unit_no ORDER BY pos ROWS UNBOUNDED PRECEDING)),
para0 AS (SELECT doc_id, unit_no, seg, page_number, grp, min(pos) AS pos, list(line ORDER BY pos) AS l FROM u2 WHERE kind IN ('text', 'gutter_gap') GROUP BY ALL),
para AS (SELECT doc_id, unit_no, seg, page_number, pos, 'paragraph' AS type,
  regexp_replace(trim(array_to_string(list_transform(l, lambda p, i: CASE WHEN i = len(l) THEN p WHEN p LIKE '%-' THEN p[:-2] ELSE p || ' ' END), '')),
    '([a-záéíóúüñ])- ([a-záéíóúüñ])', '\\1\\2', 'g') AS text, NULL AS chapter FROM para0),
own AS (SELECT doc_id, unit_no, seg, page_number, pos, kind AS type, CASE kind WHEN 'chapter_heading' THEN CASE chapter WHEN 'opening' THEN 'OPENING' WHEN 'middle' THEN 'MÍDDLE PASSAGE' ELSE 'THE CLOSING WORDS' END
  WHEN 'section_number' THEN line WHEN 'italic_block' THEN trim(line, '*_') END AS text, CASE WHEN kind = 'chapter_heading' THEN chapter END AS chapter
  FROM u2 WHERE kind IN ('chapter_heading', 'section_break', 'section_number', 'italic_block', 'needs_review')),
b0 AS (SELECT *, lag(type) OVER (PARTITION BY doc_id, unit_no, seg ORDER BY pos) AS before FROM (SELECT * FROM para WHERE text <> '' UNION ALL SELECT * FROM own)),
b1 AS (SELECT * EXCLUDE (before) FROM b0 WHERE NOT (type = 'chapter_heading' AND before IS NOT NULL AND before = 'chapter_heading'))"""


def _sql_merge(src: str, out: str, group: str, order: str) -> str:
    """Neighbouring paragraphs that break inside a sentence, as one."""
    return f"""
{out}_f AS (SELECT *, CASE WHEN type = 'paragraph' AND lag(type) OVER w = 'paragraph' AND regexp_matches(lag(text) OVER w, '[\\p{{Ll}}-]\\s*$') AND regexp_matches(text, '^\\s*\\p{{Ll}}') THEN 0 ELSE 1 END AS fresh
  FROM {src} WINDOW w AS (PARTITION BY {group} ORDER BY {order})),
{out}_i AS (SELECT *, sum(fresh) OVER (PARTITION BY {group} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS island FROM {out}_f),
{out} AS (SELECT {group}, min({order}) AS {order}, min_by(type, {order}) AS type, min_by(page_number, {order}) AS page_number, min_by(chapter, {order}) AS chapter,
  CASE WHEN count(text) = 0 THEN NULL ELSE array_to_string(list_transform(list(text ORDER BY {order}), lambda p, i: CASE WHEN i = count(*) THEN p WHEN p LIKE '%-' THEN p[:-2] ELSE p || ' ' END), '') END AS text
  FROM {out}_i GROUP BY {group}, island)"""


def _sql_merge_fixed(src: str, out: str, group: str, order: str) -> str:
    body = _sql_merge(src, out, group, order)
    head, tail = body.split(f"\n{out} AS (")
    return f"""{head}
{out}_l AS (SELECT {group}, island, min({order}) AS {order}, min_by(type, {order}) AS type, min(page_number) AS page_number,
  min_by(chapter, {order}) AS chapter, list(text ORDER BY {order}) AS l FROM {out}_i GROUP BY {group}, island),
{out} AS (SELECT {group}, {order}, type, page_number, chapter, CASE WHEN type IN ('section_break', 'needs_review') THEN NULL ELSE
  array_to_string(list_transform(l, lambda p, i: CASE WHEN i = len(l) THEN p WHEN p LIKE '%-' THEN p[:-2] ELSE p || ' ' END), '') END AS text FROM {out}_l)"""


SQL_BLOCKS = (SQL_LINES, SQL_STRUCTURED, SQL_KINDS, _SQL_BLOCKS0.strip(), _sql_merge_fixed("b1", "blocks", "doc_id, unit_no, seg", "pos").strip())

SQL_PAGES = (
    """starts AS (SELECT doc_id, unit_no, seg, page_number FROM u2 WHERE kind = 'page_marker')""",
    """arr0 AS (SELECT doc_id, unit_no, seg, page_number FROM starts UNION
  SELECT DISTINCT doc_id, unit_no, seg, page_number FROM blocks WHERE NOT (page_number IS NULL AND type = 'needs_review')),
arr1 AS (SELECT a.*, (SELECT max_by(b.chapter, b.pos) FROM blocks b WHERE b.doc_id = a.doc_id AND b.unit_no = a.unit_no AND b.seg = a.seg AND b.chapter IS NOT NULL) AS slug FROM arr0 a),
arr2 AS (SELECT *, sum(CASE WHEN page_number IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY unit_no, seg ROWS UNBOUNDED PRECEDING) AS o,
  last_value(slug IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY unit_no, seg ROWS UNBOUNDED PRECEDING) AS chapter_slug FROM arr1),
arr3 AS (SELECT *, max(page_number - 2 * o) OVER (PARTITION BY doc_id ORDER BY unit_no, seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM arr2),
arr4 AS (SELECT doc_id, unit_no, seg, page_number IS NULL AS inferred, CAST(coalesce(page_number, 2 * o + greatest(0, coalesce(m, 0))) AS INTEGER) AS page_number, chapter_slug FROM arr3),
pg AS (SELECT doc_id, page_number, count(*) AS n_arrivals, arg_min(unit_no, unit_no * 1000 + seg) AS unit_no, arg_min(seg, unit_no * 1000 + seg) AS seg,
  arg_min_null(inferred, unit_no * 1000 + seg) AS inferred, arg_min_null(chapter_slug, unit_no * 1000 + seg) AS chapter_slug FROM arr4 GROUP BY doc_id, page_number)""",
)

# blocks on their pages, repeated headings gone, mid-sentence neighbours merged again
SQL_PAGE_BLOCKS = (
    """pb0 AS (SELECT p.doc_id, p.page_number, b.type, b.text, b.chapter, CAST(row_number() OVER (PARTITION BY p.doc_id, p.page_number ORDER BY b.pos) - 1 AS INTEGER) AS block_idx
  FROM pg p JOIN blocks b ON b.doc_id = p.doc_id AND b.unit_no = p.unit_no AND b.seg = p.seg WHERE NOT (b.page_number IS NULL AND b.type = 'needs_review')),
pb1 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, CASE WHEN type = 'chapter_heading' THEN row_number() OVER (PARTITION BY doc_id, chapter ORDER BY page_number, block_idx) ELSE 1 END AS rn FROM pb0) WHERE rn = 1)""",
)


def unit_blocks(spark, sf):
    return assemble.blocks(kinds(spark, sf), BOOK, PARAMS)


def page_rows(spark, sf):
    return assemble.pages(assemble.blocks(kinds(spark, sf), BOOK, PARAMS, markers=True), book=BOOK)


def page_block_rows(spark, sf):
    """W3 + W5 on pages."""
    rows = assemble.first_headings(assemble.exploded(page_rows(spark, sf), BOOK), BOOK)
    return assemble.merge_mid_sentence(rows, ["doc_id", "page_number"], "block_idx", carry=("chapter",))


@query("unit_blocks", "W4 W5 W21 N10 P3 P16 D5", sql(*SQL_BLOCKS, select="SELECT doc_id, unit_no, seg, pos AS at, page_number, type, text, chapter FROM blocks"))
def _(spark, sf):
    return unit_blocks(spark, sf).select("doc_id", "unit_no", F.col("seg").cast("int").alias("seg"), "at", "page_number", "type", "text", "chapter")


@query("assembled_pages", "W2 W8 W9 D6 N27", sql(*SQL_BLOCKS, *SQL_PAGES, select="""
SELECT doc_id, page_number, n_arrivals, unit_no, inferred AS page_number_inferred, chapter_slug, page_number % 2 = 1 AS is_right_page FROM pg"""))
def _(spark, sf):
    return page_rows(spark, sf).select("doc_id", "page_number", "n_arrivals", "unit_no", "page_number_inferred", "chapter_slug", "is_right_page")


@query("chapter_first_page", "G10 D8", sql(*SQL_BLOCKS, *SQL_PAGES, select="SELECT doc_id, chapter_slug, min(page_number) AS first_page FROM pg WHERE chapter_slug IS NOT NULL GROUP BY doc_id, chapter_slug"))
def _(spark, sf):
    return assemble.chapter_first_pages(page_rows(spark, sf), BOOK)


@query("first_headings", "W3", sql(*SQL_BLOCKS, *SQL_PAGES, *SQL_PAGE_BLOCKS, select="SELECT doc_id, page_number, block_idx, chapter, text FROM pb1 WHERE type = 'chapter_heading'"))
def _(spark, sf):
    rows = assemble.first_headings(assemble.exploded(page_rows(spark, sf), BOOK), BOOK)
    return rows.filter(F.col("type") == "chapter_heading").select("doc_id", "page_number", "block_idx", "chapter", "text")


@query("merge_mid_sentence", "W5 R19", sql(*SQL_BLOCKS, *SQL_PAGES, *SQL_PAGE_BLOCKS, _sql_merge_fixed("pb1", "pb2", "doc_id, page_number", "block_idx").replace("min(page_number) AS page_number,\n", "\n").replace("block_idx, type, page_number, chapter, CASE", "block_idx, type, chapter, CASE").strip(), select="""
SELECT doc_id, page_number, block_idx, type, text FROM pb2"""))
def _(spark, sf):
    return page_block_rows(spark, sf).select("doc_id", "page_number", "block_idx", "type", "text")


@query("review_items", "U8 P36 D9", sql(*SQL_BLOCKS, *SQL_PAGES, """
lastp AS (SELECT doc_id, unit_no, max(page_number) AS p FROM pg GROUP BY doc_id, unit_no)""", select="""
SELECT f.doc_id, f.unit_no, f.page_number, CAST(coalesce(f.page_number, 1 + coalesce((SELECT max(p) FROM lastp l WHERE l.doc_id = f.doc_id AND l.unit_no < f.unit_no), 0)) AS VARCHAR) AS estimated
FROM blocks f WHERE f.type = 'needs_review'"""))
def _(spark, sf):
    k = kinds(spark, sf)
    blocks = assemble.blocks(k, BOOK, PARAMS, markers=True)
    items = assemble.review_items(blocks, assemble.pages(blocks, book=BOOK), BOOK)
    return items.select("doc_id", "unit_no", "page_number", F.concat_ws(",", F.transform("estimated_pages", lambda x: x.cast("string"))).alias("estimated"))


@query("front_matter_route", "P18 P36 V4", sql(SQL_LINES, SQL_STRUCTURED, """
h AS (SELECT doc_id, source, unit_no, regexp_matches(content, '(?m)^\\[Page\\s+\\d+\\]') AS has_marker FROM s_units)""", select="""
SELECT doc_id, unit_no, has_marker, coalesce(bool_or(has_marker) OVER (PARTITION BY doc_id ORDER BY unit_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS seen_marker FROM h"""))
def _(spark, sf):
    return assemble.seen_marker_before(structured_units(spark, sf), BOOK).select("doc_id", "unit_no", "has_marker", "seen_marker")


@query("orphan_routes", "P36 P18", sql(*SQL_BLOCKS, """
h AS (SELECT doc_id, source, unit_no, regexp_matches(content, '(?m)^\\[Page\\s+\\d+\\]') AS has_marker FROM s_units),
s AS (SELECT *, coalesce(bool_or(has_marker) OVER (PARTITION BY doc_id ORDER BY unit_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS seen FROM h)""", select="""
SELECT CASE WHEN b.type = 'needs_review' THEN 'review_list' WHEN s.source = 'src0' AND NOT (s.seen OR s.has_marker) THEN 'front_matter' ELSE 'inferred_page' END AS route, count(*) AS n
FROM blocks b JOIN s ON s.doc_id = b.doc_id AND s.unit_no = b.unit_no WHERE b.page_number IS NULL GROUP BY 1"""))
def _(spark, sf):
    seen = assemble.seen_marker_before(structured_units(spark, sf), BOOK).select("doc_id", "source", "unit_no", "has_marker", "seen_marker")
    rows = unit_blocks(spark, sf).join(seen, ["doc_id", "unit_no"], "inner")
    return assemble.route_orphans(rows, F.col("source") == "src0").groupBy("route").agg(F.count("*").alias("n"))


# lines of a document as one-line paragraphs on pages of five
def _line_blocks(spark, sf):
    rows = lines(spark, sf)
    return rows.select("doc_id", (F.floor(F.col("line_no") / 5) + 1).cast("int").alias("page_number"), (F.col("line_no") % 5).alias("block_idx"),
                       F.lit("paragraph").alias("type"), F.regexp_replace("line", "[.!]$", "").alias("text"))


_SQL_LB = """lb AS (SELECT doc_id, CAST(line_no // 5 + 1 AS INTEGER) AS page_number, line_no % 5 AS block_idx, regexp_replace(line, '[.!]$', '') AS text FROM lines),
pg AS (SELECT doc_id, page_number, count(*) AS n, arg_min(text, block_idx) AS first, arg_max(text, block_idx) AS last, max(block_idx) AS e FROM lb GROUP BY doc_id, page_number)"""


def _sql_cross(cond: str, glue: str) -> str:
    """One-hop merges across pages, decided page after page by recursion."""
    return sql(SQL_LINES, _SQL_LB, f"""
f AS (SELECT doc_id, page_number, n, e, lead(first) OVER w AS nxt, coalesce({cond}, false) AS fires FROM pg WINDOW w AS (PARTITION BY doc_id ORDER BY page_number)),
r AS (SELECT doc_id, page_number, fires AS gives FROM f WHERE page_number = 1
  UNION ALL SELECT f.doc_id, f.page_number, f.fires AND NOT (f.n = 1 AND r.gives) FROM f JOIN r ON f.doc_id = r.doc_id AND f.page_number = r.page_number + 1)""", select=f"""
SELECT b.doc_id, b.page_number, b.block_idx, CASE WHEN r.gives AND b.block_idx = f.e THEN {glue} ELSE b.text END AS text
FROM lb b JOIN f ON f.doc_id = b.doc_id AND f.page_number = b.page_number JOIN r ON r.doc_id = b.doc_id AND r.page_number = b.page_number
LEFT JOIN r q ON q.doc_id = b.doc_id AND q.page_number = b.page_number - 1 WHERE NOT (b.block_idx = 0 AND coalesce(q.gives, false))""").replace("WITH ", "WITH RECURSIVE ", 1)


_LOW = "regexp_replace(lower({x}), '^.', lower({x})[1])"


@query("cross_page_merge", "W6 W13", _sql_cross("regexp_matches(last, '[\\p{Ll}-]\\s*$') AND (page_number % 3 = 0 OR regexp_matches(lead(first) OVER w, '^\\s*\\p{Ll}'))",
       "CASE WHEN b.text LIKE '%-' THEN b.text[:-2] || f.nxt ELSE b.text || ' ' || f.nxt END").replace(
           "regexp_replace(line, '[.!]$', '') AS text FROM lines", "CASE WHEN (line_no // 5) % 3 = 0 AND line_no % 5 = 0 THEN lower(regexp_replace(line, '[.!]$', '')) ELSE regexp_replace(line, '[.!]$', '') END AS text FROM lines").replace(
           "(page_number % 3 = 0 OR regexp_matches(lead(first) OVER w, '^\\s*\\p{Ll}'))", "regexp_matches(lead(first) OVER w, '^\\s*\\p{Ll}')"))
def _(spark, sf):
    rows = _line_blocks(spark, sf)
    low = F.when(((F.col("page_number") - 1) % 3 == 0) & (F.col("block_idx") == 0), F.lower("text")).otherwise(F.col("text"))
    return assemble.merge_across_pages(rows.withColumn("text", low), BOOK).select("doc_id", "page_number", "block_idx", "text")


@query("page_fragment_merge", "W7", _sql_cross("NOT regexp_matches(last, '[.!?…\"'')\\]]\\s*$') OR regexp_matches(lead(first) OVER w, '^\\p{Ll}')",
       "rtrim(b.text) || ' ' || ltrim(f.nxt)").replace("coalesce(NOT", "lead(first) OVER w IS NOT NULL AND coalesce(NOT"))
def _(spark, sf):
    return assemble.merge_across_pages(_line_blocks(spark, sf), BOOK, either=True).select("doc_id", "page_number", "block_idx", "text")


@query("clean_text", "S12 S11", sql(*SQL_BLOCKS, *SQL_PAGES, *SQL_PAGE_BLOCKS, """
r AS (SELECT doc_id, page_number, block_idx, CASE type WHEN 'chapter_heading' THEN chr(10) || text || chr(10) WHEN 'section_number' THEN text
  WHEN 'section_break' THEN chr(10) || '[section break]' || chr(10) WHEN 'paragraph' THEN text || chr(10) WHEN 'italic_block' THEN '_' || text || '_' || chr(10) END AS t FROM pb1)""", select="""
SELECT p.doc_id, p.page_number, '[Page ' || p.page_number || CASE WHEN any_value(p.inferred) THEN ' (inferred)' ELSE '' END || ']' || chr(10)
  || coalesce(string_agg(r.t, chr(10) ORDER BY r.block_idx) || chr(10), '') AS text
FROM pg p LEFT JOIN r ON r.doc_id = p.doc_id AND r.page_number = p.page_number GROUP BY p.doc_id, p.page_number"""))
def _(spark, sf):
    rows = page_rows(spark, sf)
    blocks = assemble.first_headings(assemble.exploded(rows, BOOK), BOOK).filter(F.col("type") != "needs_review")
    item = F.struct("block_idx", "type", "text", F.lit(None).cast("string").alias("source_pdf"), F.lit(None).cast("int").alias("spread_number"))
    listed = blocks.groupBy("doc_id", "page_number").agg(F.sort_array(F.collect_list(item)).alias("_b"))
    rows = rows.select("doc_id", "page_number", "page_number_inferred").join(listed, ["doc_id", "page_number"], "left")
    empty = F.slice(F.array(F.lit(None).cast(rows.schema["_b"].dataType.elementType)), 1, 0)
    return rows.select("doc_id", "page_number", paged.render(F.col("page_number"), F.col("page_number_inferred"), F.coalesce("_b", empty)).alias("text"))


@query("block_records", "N34 N37 N33", sql(*SQL_BLOCKS, select="""
SELECT doc_id, unit_no, seg, count(*) AS n_blocks, count(*) FILTER (type = 'needs_review') AS n_provenance, count(text) AS n_texts,
  coalesce(string_agg(text, ' ' ORDER BY pos) FILTER (type = 'paragraph'), '') AS prose FROM blocks GROUP BY doc_id, unit_no, seg"""))
def _(spark, sf):
    item = F.struct("at", T.block_struct(F.col("type"), F.col("text"), F.col("doc_id"), F.col("unit_no")).alias("b"))
    rows = unit_blocks(spark, sf).groupBy("doc_id", "unit_no", F.col("seg").cast("int").alias("seg")).agg(F.sort_array(F.collect_list(item)).alias("_b"))
    rows = rows.withColumn("front", T.front_matter(F.col("_b.b")))
    content = F.get("front", F.lit(0))["content_blocks"]
    count = lambda f: F.size(F.filter(content, f)).cast("bigint")
    return rows.select("doc_id", "unit_no", "seg", F.size(content).cast("bigint").alias("n_blocks"), count(lambda b: b["source_pdf"].isNotNull()).alias("n_provenance"),
                       count(lambda b: b["text"].isNotNull()).alias("n_texts"), T.blocks_text(content).alias("prose"))


@query("page_number_limits", "G13 O2", sql(SQL_LINES, sql_pages("lines", "p"), select="SELECT source, max(page_number) AS max_page, min(page_number) AS min_page, count(*) AS n_pages FROM p GROUP BY source"))
def _(spark, sf):
    return pages(spark, sf).groupBy("source").agg(F.max("page_number").alias("max_page"), F.min("page_number").alias("min_page"), F.count("*").alias("n_pages"))


@query("cross_page_fragments", "W15 W13", sql(SQL_LINES, """
lb AS (SELECT doc_id, CAST(line_no // 5 + 1 AS INTEGER) AS page_number, line_no % 5 AS i, CASE WHEN line_no % 10 = 5 THEN lower(line) ELSE regexp_replace(line, '[.!]$', '') END AS line FROM lines),
pg AS (SELECT doc_id, page_number, rtrim(arg_max(line, i)) AS last, ltrim(arg_min(line, i)) AS first FROM lb GROUP BY doc_id, page_number),
nx AS (SELECT *, lead(first) OVER (PARTITION BY doc_id ORDER BY page_number) AS nxt FROM pg)""", select="""
SELECT doc_id, page_number AS page, 'FRAGMENT' AS type, '…' || right(last, 60) || ' ↦ ' || nxt[:60] || '…' AS excerpt FROM nx
WHERE nxt IS NOT NULL AND NOT (upper(last) = last AND lower(last) <> last) AND length(last) >= 5 AND NOT regexp_matches(last, '[.!?…"'')\\]—]\\s*$') AND regexp_matches(nxt, '^\\p{Ll}')"""))
def _(spark, sf):
    text = F.when(F.col("line_no") % 10 == 5, F.lower("line")).otherwise(F.regexp_replace("line", "[.!]$", ""))
    rows = lines(spark, sf).select("doc_id", (F.floor(F.col("line_no") / 5) + 1).cast("int").alias("page_number"), "line_no", text.alias("t"))
    rows = rows.groupBy("doc_id", "page_number").agg(F.sort_array(F.collect_list(F.struct("line_no", "t"))).alias("_b")).select("doc_id", "page_number", F.col("_b.t").alias("blocks"))
    return qa.fragments(rows, BOOK).drop("notes")


@query("blank_page_runs", "W16 G8", sql(SQL_LINES, """
t AS (SELECT doc_id, CAST(line_no + 1 AS INTEGER) AS page_number, CASE WHEN (doc_id + line_no // 3) % 2 = 0 THEN CASE WHEN line_no % 2 = 0 THEN '' ELSE ' 12 ' END ELSE line END AS text FROM lines),
b AS (SELECT *, trim(text) = '' OR regexp_matches(trim(text), '^\\d+$') AS blank FROM t),
i AS (SELECT *, sum(CASE WHEN blank THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY page_number ROWS UNBOUNDED PRECEDING) AS island FROM b),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, island, blank ORDER BY page_number) AS run FROM i)""", select="""
SELECT doc_id, page_number AS page, 'LAYOUT' AS type, 'blank page ' || run || ' of a run' AS notes FROM r WHERE blank AND run > 1"""))
def _(spark, sf):
    n = F.col("line_no")
    text = F.when((F.col("doc_id") + F.floor(n / 3)) % 2 == 0, F.when(n % 2 == 0, "").otherwise(" 12 ")).otherwise(F.col("line"))
    return qa.blank_runs(lines(spark, sf).select("doc_id", (n + 1).alias("page_number"), text.alias("text")), BOOK).drop("excerpt")


@query("even_chapter_pages", "W16 N27 O8", sql(*SQL_BLOCKS, *SQL_PAGES, *SQL_PAGE_BLOCKS, select="""
SELECT doc_id, page_number AS page, arg_min(text, block_idx) AS excerpt FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY block_idx) AS rn FROM pb0 WHERE coalesce(text, '') <> '')
WHERE rn <= 6 AND text IN ('OPENING', 'MÍDDLE PASSAGE', 'THE CLOSING WORDS') AND page_number % 2 = 0 GROUP BY doc_id, page_number"""))
def _(spark, sf):
    rows = assemble.exploded(page_rows(spark, sf), BOOK)
    listed = rows.groupBy("doc_id", "page_number").agg(F.sort_array(F.collect_list(F.struct("block_idx", "text"))).alias("_b"))
    text = listed.select("doc_id", "page_number", F.array_join("_b.text", "\n").alias("text"))
    return qa.even_chapters(text, tuple(c.heading for c in PARAMS.chapters), BOOK).select("doc_id", "page", "excerpt")


@query("artifact_scan", "P33 N20 D20", sql(SQL_LINES, """
t AS (SELECT doc_id, line_no, CASE (doc_id + line_no) % 5 WHEN 0 THEN '[Page LEFT 3] ' || line WHEN 1 THEN line || ' [ornamental break] tail' WHEN 2 THEN '※' || line || '※' WHEN 3 THEN 'Current text ' || line ELSE line END AS line FROM lines),
p AS (SELECT doc_id, CAST(line_no // 5 + 1 AS INTEGER) AS page, string_agg(line, ' ' ORDER BY line_no) AS text FROM t GROUP BY doc_id, line_no // 5 + 1),
h AS (SELECT doc_id, page, 'page marker left in the text' AS notes, len(regexp_extract_all(text, '(?i)\\[Page(?:\\s+LEFT|\\s+RIGHT)?\\s*\\d*\\]')) AS n FROM p
  UNION ALL SELECT doc_id, page, 'ornament spelled out', len(regexp_extract_all(text, '(?i)\\[(?:decorative|ornamental|ornament)\\s*(?:symbol|break|element)?\\]')) FROM p
  UNION ALL SELECT doc_id, page, 'doubt sign left in the text', len(regexp_extract_all(text, '※')) FROM p
  UNION ALL SELECT doc_id, page, 'name of a reading left in the text', len(regexp_extract_all(text, '(?i)\\bReading [A-Z] has\\b|\\bCurrent\\s+text\\b')) FROM p)""", select="""
SELECT doc_id, page, notes, CAST(n AS BIGINT) AS n FROM h WHERE n > 0"""))
def _(spark, sf):
    h, line = (F.col("doc_id") + F.col("line_no")) % 5, F.col("line")
    t = (
        F.when(h == 0, F.concat(F.lit("[Page LEFT 3] "), line)).when(h == 1, F.concat(line, F.lit(" [ornamental break] tail")))
        .when(h == 2, F.concat(F.lit("※"), line, F.lit("※"))).when(h == 3, F.concat(F.lit("Current text "), line)).otherwise(line)
    )
    rows = lines(spark, sf).select("doc_id", (F.floor(F.col("line_no") / 5) + 1).cast("int").alias("page_number"), "line_no", t.alias("t"))
    rows = rows.groupBy("doc_id", "page_number").agg(F.sort_array(F.collect_list(F.struct("line_no", "t"))).alias("_b"))
    rows = rows.select("doc_id", "page_number", F.array_join("_b.t", " ").alias("text"))
    return qa.artifacts(rows, BOOK, PARAMS).groupBy("doc_id", "page", "notes").agg(F.count("*").alias("n"))


@query("uncertain_first_paragraph", "W17", sql(SQL_LINES, select="""
SELECT doc_id, CAST(line_no // 5 + 1 AS INTEGER) AS page_number, line_no % 5 AS block_idx,
  coalesce(d.quality = 0, false) AND row_number() OVER (PARTITION BY doc_id, line_no // 5, line LIKE '%,%' ORDER BY line_no) = 1 AND line LIKE '%,%' AS marked
FROM lines LEFT JOIN labels d USING (doc_id)"""))
def _(spark, sf):
    from variorum.plans.corpus import table

    flags = table(spark, sf, "labels").select("doc_id", (F.col("quality") == 0).alias("_uncertain"))
    rows = _line_blocks_raw(spark, sf).join(flags, "doc_id", "left").withColumn("_uncertain", F.coalesce("_uncertain", F.lit(False)))
    return assemble.mark_first_paragraph(rows, BOOK).select("doc_id", "page_number", "block_idx", "marked")


def _line_blocks_raw(spark, sf):
    kind = F.when(F.col("line").contains(","), "paragraph").otherwise("section_number")
    return lines(spark, sf).select("doc_id", (F.floor(F.col("line_no") / 5) + 1).cast("int").alias("page_number"), (F.col("line_no") % 5).alias("block_idx"), kind.alias("type"), F.col("line").alias("text"))


@query("unit_ranks", "W18 O1 D2", "SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS BIGINT) AS unit_no FROM documents")
def _(spark, sf):
    docs = ordered.with_bucket(documents(spark, sf).select("doc_id", "source"), "doc_id", 2048)
    ranked = ordered.row_number(docs, ["source"], ["doc_id"], "unit_no", "bucket")
    return ranked.select("doc_id", "source", "unit_no")


@query("language_fill", "W2 W13", """
SELECT doc_id, source, last_value(CASE WHEN text LIKE '%|%' THEN lang END IGNORE NULLS) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS filled,
  lead(doc_id) OVER (PARTITION BY source ORDER BY doc_id) AS next_doc FROM documents""")
def _(spark, sf):
    docs = documents(spark, sf).select("doc_id", "source", F.when(F.col("text").contains("|"), F.col("lang")).alias("mark"))
    docs = ordered.with_bucket(docs, "doc_id", 2048)
    docs = ordered.fill_forward(docs, ["source"], ["doc_id"], F.col("mark"), "filled", "bucket")
    docs = ordered.neighbour(docs, ["source"], ["doc_id"], ["doc_id"], "nxt", "bucket")
    return docs.select("doc_id", "source", "filled", F.col("nxt.doc_id").alias("next_doc"))
