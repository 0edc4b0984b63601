"""Unit logs written and read back, keyed updates, resume."""

from __future__ import annotations

from pyspark.sql import functions as F

from variorum.plans.corpus import SQL_LINES, documents, sql, sql_pages, sql_units, table, units
from variorum.plans.registry import query
from variorum.sources import unit_log
from variorum.streaming import resume

KEYS = ["book", "unit_no"]
_U = (SQL_LINES, sql_pages("lines", "p"), sql_units("p", "u"))


def _logs(spark, sf):
    """One log per document; the block of the last unit stays open where the text has a bar, and unit 1 is written twice."""
    rows = units(spark, sf).join(documents(spark, sf).select("doc_id", F.col("text").contains("|").alias("cut")), "doc_id", "inner")
    block = unit_log.format_block(F.col("doc_id").cast("string"), F.col("unit_no"), F.col("total"), F.col("content"))
    is_cut = F.col("cut") & (F.col("unit_no") == F.col("total"))
    block = F.when(is_cut, F.replace(block, F.lit(unit_log.END), F.lit(""))).otherwise(block)
    draft = unit_log.format_block(F.col("doc_id").cast("string"), F.col("unit_no"), F.col("total"), F.lit("a first try"))
    block = F.when((F.col("unit_no") == 1) & ~is_cut, F.concat(draft, block)).otherwise(block)
    logs = rows.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("unit_no", block.alias("b")))).alias("_b"))
    return logs.select("doc_id", F.concat(F.lit("# a reading\n# Source: x\n"), F.array_join("_b.b", "")).alias("log"))


_CUT = "k AS (SELECT u.*, d.text LIKE '%|%' AND unit_no = max(unit_no) OVER (PARTITION BY u.doc_id) AS cut FROM u JOIN documents d USING (doc_id))"


@query("unit_log_scan", "S1 S2 S9 D1 W10", sql(*_U, _CUT, select="""
SELECT CAST(doc_id AS VARCHAR) AS book, unit_no, CAST(max(unit_no) OVER (PARTITION BY doc_id) AS INTEGER) AS total, trim(content, ' ' || chr(10) || chr(9) || chr(13)) AS content FROM k QUALIFY NOT cut"""))
def _(spark, sf):
    return unit_log.complete_units(unit_log.parse_log(_logs(spark, sf), "log", ["doc_id"])).select("book", "unit_no", "total", "content")


@query("unit_log_audit", "S1 S8 S16", sql(*_U, _CUT, select="SELECT 'unterminated' AS action, doc_id || ' unit ' || unit_no AS reason FROM k WHERE cut"))
def _(spark, sf):
    return unit_log.unterminated(unit_log.parse_log(_logs(spark, sf), "log", ["doc_id"])).select("action", "reason")


@query("resume_high_water", "V1 V6", sql(*_U, _CUT, select="SELECT CAST(doc_id AS VARCHAR) AS book, max(unit_no) AS last_done FROM k WHERE NOT cut GROUP BY doc_id"))
def _(spark, sf):
    return resume.high_water(unit_log.parse_log(_logs(spark, sf), "log", ["doc_id"]))


@query("resume_pending", "V2 T6", sql(*_U, _CUT, select="SELECT CAST(doc_id AS VARCHAR) AS book, unit_no FROM k WHERE cut"))
def _(spark, sf):
    wanted = units(spark, sf).select(F.col("doc_id").cast("string").alias("book"), "unit_no")
    return resume.pending(wanted, unit_log.complete_units(unit_log.parse_log(_logs(spark, sf), "log", ["doc_id"])))


@query("targeted_load", "V5 J5", sql(*_U, _CUT, select="""
SELECT CAST(doc_id AS VARCHAR) AS book, unit_no, CASE WHEN cut THEN 'produced' ELSE 'kept' END AS origin FROM k WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)"""))
def _(spark, sf):
    bad = table(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    wanted = units(spark, sf).join(bad, "doc_id", "left_semi").select(F.col("doc_id").cast("string").alias("book"), "unit_no")
    done = unit_log.complete_units(unit_log.parse_log(_logs(spark, sf), "log", ["doc_id"])).select(*KEYS, F.lit("kept").alias("origin"))
    return resume.targeted(wanted, done, wanted.withColumn("origin", F.lit("produced")))


@query("block_replace", "S10 V3", sql(*_U, select="""
SELECT u.doc_id, u.unit_no, CASE WHEN l.doc_id IS NOT NULL THEN 'read again' ELSE u.content END AS content, l.doc_id IS NOT NULL AS replaced
FROM u LEFT JOIN (SELECT doc_id FROM labels WHERE quality = 0) l USING (doc_id)"""))
def _(spark, sf):
    rows = units(spark, sf).select("doc_id", "unit_no", "content")
    poor = table(spark, sf, "labels").filter("quality = 0").select("doc_id")
    new = rows.join(poor, "doc_id", "left_semi").select("doc_id", "unit_no", F.lit("read again").alias("content"))
    return unit_log.replace_units(rows, new, ["doc_id", "unit_no"])


@query("positional_results", "J11 X3", """
SELECT c.conv_id AS batch, c.turn, CAST(row_number() OVER w - 1 AS INTEGER) AS ordinal, nullif(trim(CASE WHEN c.role = 'user' THEN '' ELSE text END), '') AS content
FROM conversations c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def _(spark, sf):
    rows = table(spark, sf, "conversations").withColumnRenamed("conv_id", "batch")
    text = F.when(F.col("role") == "user", "").otherwise(F.col("text"))
    # a reader's answer to one request list: the texts in request order
    results = rows.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("turn", text.alias("t")))).alias("_t")).select("batch", F.col("_t.t").alias("texts"))
    return unit_log.positional_results(rows.select("batch", "turn"), results, ["turn"]).select("batch", "turn", "ordinal", "content")


@query("flat_output_scan", "S23", sql(*_U, select="""
SELECT CAST(doc_id AS VARCHAR) AS book, unit_no, CAST(max(unit_no) OVER (PARTITION BY doc_id) AS INTEGER) AS total, trim(content, ' ' || chr(10) || chr(9) || chr(13)) AS content FROM u"""))
def _(spark, sf):
    rule = F.lit(unit_log.RULE)
    head = F.concat(F.col("doc_id").cast("string"), F.lit("  |  Spread "), F.col("unit_no").cast("string"), F.lit("/"), F.col("total").cast("string"), F.lit("\n"), rule, F.lit("\n\n"))
    return unit_log.parse_flat(units(spark, sf).withColumn("r", F.concat(head, "content", F.lit("\n\n\n"))), "r").select("book", "unit_no", "total", "content")


@query("latest_version", "S22 O9", "SELECT source, source || '-' || max(doc_id) || '.pdf' AS latest, CAST(max(doc_id) AS INTEGER) AS version FROM documents GROUP BY source")
def _(spark, sf):
    rows = documents(spark, sf).select("source", F.concat("source", F.lit("-"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("name"))
    return unit_log.latest_version(rows, F.col("name"), ["source"])


@query("leading_units_skip", "S3", sql(*_U, select="SELECT source AS book, doc_id, unit_no FROM u WHERE NOT (source = 'src0' AND unit_no <= 5)"))
def _(spark, sf):
    rows = units(spark, sf).select(F.col("source").alias("book"), "doc_id", "unit_no")
    return unit_log.skip_leading(rows, "src0", 5)


@query("issue_report", "S24 G8 O4 T3", sql(SQL_LINES, sql_pages("lines", "p"), """
i AS (SELECT doc_id, page_number, 'FRAGMENT' AS type, text[:60] AS e FROM p WHERE regexp_matches(text, '[\\p{L}]$'))""", select="""
SELECT doc_id, rpad(CAST(page_number AS VARCHAR), 6, ' ') || '  ' || rpad(type, 12, ' ') || '  ' || rpad(e[:49], 50, ' ') || '  ' || 'ends without a stop' AS line FROM i"""))
def _(spark, sf):
    from variorum.plans.corpus import pages
    from variorum.sources.structured import issue_line

    rows = pages(spark, sf).filter(F.col("text").rlike(r"[\p{L}]$"))
    return rows.select("doc_id", issue_line(F.col("page_number"), F.lit("FRAGMENT"), F.substring("text", 1, 60), F.lit("ends without a stop")).alias("line"))


@query("quality_verdict", "G8 P33 W14 W15 W16 S24", None)
def _(spark, sf):
    """Issues of every check per document, and whether it is ready for a reader."""
    from variorum.operators import qa
    from variorum.plans.corpus import pages

    flat = pages(spark, sf)
    listed = flat.withColumn("blocks", F.split("text", "\n"))
    issues = qa.all_issues(qa.artifacts(flat, ("doc_id",)), qa.duplicates(flat, ("doc_id",)), qa.fragments(listed, ("doc_id",)), qa.blank_runs(flat, ("doc_id",)))
    return qa.verdict(documents(spark, sf).select("doc_id"), issues, ("doc_id",))
