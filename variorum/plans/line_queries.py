"""Line rules, page segmentation and unit logs' inner structure."""

from __future__ import annotations

from pyspark.sql import functions as F

from variorum.functions import predicates as P
from variorum.functions import text as T
from variorum.operators import assemble
from variorum.plans.corpus import (
    PARAMS, SQL_KINDS, SQL_LINES, SQL_STRUCTURED, book_text, documents, fold, lines, sql, sql_pages, sql_units, structured_units, units,
)
from variorum.plans.registry import query
from variorum.sources import paged

BOOK = ("doc_id",)


def kinds(spark, sf):
    return assemble.classify_lines(assemble.lines(structured_units(spark, sf), BOOK), params=PARAMS)


@query("line_kinds", "P2 P3 P8 P9 P10 P11 P12 P13 P14 P15 P16 P17 A10", sql(SQL_LINES, SQL_STRUCTURED, SQL_KINDS, select="""
SELECT doc_id, unit_no, pos AS line_no, line, kind, chapter FROM s_kinds"""))
def _(spark, sf):
    return kinds(spark, sf).select("doc_id", "unit_no", "line_no", "line", "kind", "chapter")


@query("line_kind_counts", "P17", sql(SQL_LINES, SQL_STRUCTURED, SQL_KINDS, select="SELECT kind, count(*) AS n FROM s_kinds GROUP BY kind"))
def _(spark, sf):
    return kinds(spark, sf).groupBy("kind").agg(F.count("*").alias("n"))


@query("bare_number_lines", "P10", sql(SQL_LINES, """
n AS (SELECT doc_id, line_no, CASE WHEN (doc_id + line_no) % 5 = 0 THEN CAST((doc_id * 7 + line_no) % 700 AS VARCHAR) ELSE line END AS line FROM lines)""", select="""
SELECT doc_id, line_no, line FROM n WHERE regexp_matches(line, '^\\d{1,4}$') AND try_cast(line AS INTEGER) BETWEEN 1 AND 500"""))
def _(spark, sf):
    n = F.when((F.col("doc_id") + F.col("line_no")) % 5 == 0, ((F.col("doc_id") * 7 + F.col("line_no")) % 700).cast("string")).otherwise(F.col("line"))
    rows = lines(spark, sf).select("doc_id", "line_no", n.alias("line"))
    return rows.filter(P.is_bare_number(F.col("line")))


@query("marker_strip", "P6 N36", sql(SQL_LINES, SQL_STRUCTURED, select="""
SELECT doc_id, unit_no,
  regexp_replace(content, '(?mi)<<< SPREAD_(?:START|END)[^>]*>>>|^#[^\\n]*$|^\\[Page\\s+\\d+[^\\]]*\\]\\s*$|^\\[section break\\]\\s*$|^COLLECTED WITNESSES\\s*$|^EDITED BY[ \\t]*$', ' ', 'g') AS strict,
  regexp_replace(content, '(?mi)<<< SPREAD_(?:START|END)[^>]*>>>|^#[^\\n]*$|^\\[Page\\s+\\d+[^\\]]*\\]\\s*$|^\\[section break\\]\\s*$|^COLLECTED WITNESSES\\s*$|^EDITED BY[^\\n]*$', ' ', 'g') AS loose
FROM s_units"""))
def _(spark, sf):
    kw = dict(titles=PARAMS.running_titles, authors=PARAMS.author_prefixes)
    c = F.col("content")
    return structured_units(spark, sf).select("doc_id", "unit_no", T.clean_block(c, **kw).alias("strict"), T.clean_block(c, strict=False, **kw).alias("loose"))


@query("header_strip", "P7 S3", sql(SQL_LINES, SQL_STRUCTURED, select="""
SELECT doc_id, unit_no, regexp_replace(regexp_replace(regexp_replace(content, '(?mi)^COLLECTED WITNESSES\\s*$', '', 'g'), '(?mi)^\\[section break\\]\\s*$', '', 'g'),
  '(?m)^[A-ZÁÉÍÓÚÜÑ][A-ZÁÉÍÓÚÜÑ\\s\\-]{3,}$', '', 'g') AS body FROM s_units"""))
def _(spark, sf):
    body = P.strip_allcaps(P.strip_section_breaks(P.strip_headers(F.col("content"), PARAMS.running_titles)))
    return structured_units(spark, sf).select("doc_id", "unit_no", body.alias("body"))


@query("failed_units", "P2 P4 G11", sql(SQL_LINES, SQL_STRUCTURED, """
f AS (SELECT source, doc_id, unit_no, regexp_matches(string_split(content, chr(10))[1], '\\[(?:NEEDS_REVIEW|EXTRACTION_ERROR)') AS whole,
  len(regexp_extract_all(content, '\\[NEEDS_REVIEW: .+? spread (\\d+)')) AS n FROM s_units)""", select="""
SELECT source, count(*) FILTER (whole) AS n_whole, count(*) FILTER (n > 0) AS n_units, CAST(sum(n) AS BIGINT) AS n_markers FROM f GROUP BY source"""))
def _(spark, sf):
    c = F.col("content")
    rows = structured_units(spark, sf).select("source", P.unit_failed(c).alias("whole"), F.size(P.failed_unit_numbers(c)).alias("n"))
    return rows.groupBy("source").agg(F.count_if("whole").alias("n_whole"), F.count_if(F.col("n") > 0).alias("n_units"), F.sum("n").alias("n_markers"))


@query("page_segments", "S4 W1 W10 D4", sql(SQL_LINES, sql_pages("lines", "p"), select="""
SELECT doc_id, page_number, trim(text, ' ' || chr(10)) AS text, false AS inferred, CAST(1 AS BIGINT) AS n_markers FROM p"""))
def _(spark, sf):
    flat = documents(spark, sf).select("doc_id", book_text(F.split("text", "\n")).alias("flat"))
    return paged.pages(flat, "flat", ["doc_id"]).select("doc_id", "page_number", "text", "inferred", "n_markers")


@query("page_segments_bottom", "S4 S13", sql(SQL_LINES, sql_pages("lines", "p"), select="""
SELECT doc_id, page_number, trim(text, ' ' || chr(10)) AS text FROM p QUALIFY page_number < max(page_number) OVER (PARTITION BY doc_id)"""))
def _(spark, sf):
    # the same flat text read with markers below their page: page k then holds what stands above marker k
    flat = documents(spark, sf).select("doc_id", book_text(F.split("text", "\n")).alias("flat"))
    rows = paged.pages(flat, "flat", ["doc_id"], marker="bottom").filter("page_number > 1")
    return rows.select("doc_id", (F.col("page_number") - 1).alias("page_number"), "text")


@query("page_status", "P21", sql(SQL_LINES, SQL_STRUCTURED, select="""
SELECT doc_id, unit_no, CASE WHEN regexp_matches(content, '\\[EXTRACTION FAILED|\\[NEEDS_REVIEW|\\[NEEDS MANUAL TRANSCRIPTION') THEN 'missing' ELSE 'present' END AS status FROM s_units"""))
def _(spark, sf):
    return structured_units(spark, sf).select("doc_id", "unit_no", P.page_status(F.col("content")).alias("status"))


@query("sentence_edges", "P19", sql(SQL_LINES, select="""
SELECT doc_id, line_no, regexp_matches(line, '[\\p{Ll}-]\\s*$') AS ends_mid, regexp_matches(line, '^\\s*\\p{Ll}') AS starts_mid FROM lines"""))
def _(spark, sf):
    c = F.col("line")
    return lines(spark, sf).select("doc_id", "line_no", P.ends_mid_sentence(c).alias("ends_mid"), P.starts_mid_sentence(c).alias("starts_mid"))


@query("garbled_tokens", "P20", f"""
SELECT t AS token, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(upper({fold('text')}), '\\s+')) AS t FROM documents)
WHERE regexp_matches(trim(t), '^(?:\\d{{3,}}|[A-Z]{{2,4}}\\d{{2}}[\\s\\d\\-a-z]+|[A-Z]{{2,6}}(?:\\s+\\d[\\d\\-]*)+|[A-Z]{{3,6}})$') GROUP BY t""")
def _(spark, sf):
    rows = documents(spark, sf).select(F.explode(T.tokens_ws(F.upper(T.fold(F.col("text"))))).alias("token"))
    return rows.filter(P.is_garbled(F.col("token"))).groupBy("token").agg(F.count("*").alias("n"))


@query("unit_page_index", "S3 G19 W10", sql(SQL_LINES, sql_pages("lines", "p"), sql_units("p", "u"), """
c AS (SELECT doc_id, unit_no, CAST(unnest(regexp_extract_all(content || CASE WHEN unit_no % 2 = 0 THEN chr(10) || '[Page 1]' ELSE '' END, '\\[Page (\\d+)\\]', 1)) AS INTEGER) AS page_number FROM u)""", select="""
SELECT doc_id, page_number, max(unit_no) AS unit_no, count(*) AS n_claims FROM c GROUP BY doc_id, page_number"""))
def _(spark, sf):
    from variorum.sources.unit_log import page_index

    again = F.when(F.col("unit_no") % 2 == 0, F.concat("content", F.lit("\n[Page 1]"))).otherwise(F.col("content"))
    return page_index(units(spark, sf).withColumn("content", again), BOOK)


@query("smoke_gate", "X4 P35", """
WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, array_to_string(w[i + 1:i + 8], ' ') AS g FROM (SELECT doc_id, w, unnest(range(len(w) - 7)) AS i FROM w)),
l AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, g, count(*) AS n FROM g GROUP BY doc_id, g) WHERE n >= 3)
SELECT d.doc_id, length(trim(d.text)) >= 30 AND l.doc_id IS NULL AS ok, length(trim(d.text)) AS n_chars FROM documents d LEFT JOIN l USING (doc_id)""")
def _(spark, sf):
    from variorum.operators.dedup import repetition_loop

    docs = documents(spark, sf).select("doc_id", "text")
    loops = repetition_loop(docs, "text", BOOK).select("doc_id", F.lit(True).alias("looped"))
    rows = docs.join(loops, "doc_id", "left")
    return rows.select("doc_id", P.smoke_ok(F.col("text"), F.coalesce("looped", F.lit(False))).alias("ok"), F.length(F.trim("text")).cast("bigint").alias("n_chars"))
