"""Queries that need sequence alignment; their oracles align by recursion in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from variorum.functions import align as A
from variorum.functions import text as T
from variorum.operators import assemble, dedup, fallback, rules, score, spans
from variorum.plans.align_sql import PAGES, QC, QM, SPANS, UNITS, recursive
from variorum.plans.corpus import PARAMS, dealt, documents, lines, pages, units
from variorum.plans.join_queries import line_blocks
from variorum.plans.registry import query
from variorum.sources import structured
from variorum.sources.unit_log import page_index

BOOK = ("doc_id",)
KEYS = ["doc_id", "unit_no"]


def aligned(spark, sf, fourth=False, **kw):
    """Both readings and the base of every unit, with words moved, split, dropped and added."""
    o = units(spark, sf, "o", moving=True) if fourth else None
    return spans.aligned(units(spark, sf, "q", moving=True), units(spark, sf, "m", moving=True), pages(spark, sf, "c", moving=True), BOOK, o, PARAMS, **kw)


def divergences(spark, sf, contexts=True, **kw):
    return spans.divergences(aligned(spark, sf, **kw), BOOK, params=PARAMS, contexts=contexts)


@query("diff_opcodes", "A1 A3 D11 D12", recursive(*UNITS, QM, QC, select="""
SELECT doc_id, unit_no, CAST(len(q) AS INTEGER) AS n_q, coalesce(mapped, 0) AS c_mapped, op_no, tag, i1, i2, j1, j2
FROM qm_ops JOIN al USING (k) LEFT JOIN (SELECT k, sum(n)::INT AS mapped FROM qc_mb GROUP BY k) USING (k)"""))
def _(spark, sf):
    rows = aligned(spark, sf).select(*KEYS, F.size("q").alias("n_q"), "c_mapped", F.posexplode("ops").alias("op_no", "o"))
    return rows.select(*KEYS, "n_q", "c_mapped", "op_no", "o.tag", "o.i1", "o.i2", "o.j1", "o.j2")


@query("majority_spans", "S2 N11 N1 J1 J2 A1 A3 A5 P24 G4 B1", recursive(*UNITS, *SPANS, select="SELECT source, type, count(*) AS n FROM sp GROUP BY source, type"))
def _(spark, sf):
    """Divergent spans of each majority class per source."""
    # a document belongs to one source, so the class counts of documents are summed after a join on the small side
    per_doc = divergences(spark, sf, contexts=False).groupBy("doc_id", "type").agg(F.count("*").alias("n"))
    src = documents(spark, sf).select("doc_id", "source")
    return per_doc.join(src, "doc_id", "inner").groupBy("source", "type").agg(F.sum("n").alias("n"))


@query("divergence_report", "A5 N21 D13 S14 O3")
def _(spark, sf):
    return divergences(spark, sf).select(*KEYS, "span_no", T.page_label(F.col("pages")).alias("pages"), "left_ctx", "q_span", "m_span", "c_span", "right_ctx", "type")


@query("unresolved_report", "U3 U4 N22 W20 P27 P28 D14 S25")
def _(spark, sf):
    rows = spans.enriched(aligned(spark, sf), BOOK, PARAMS)
    return rows.withColumn("severity", spans.severity_rank(F.col("category"))).drop("pages", "i1", "i2", "j1", "j2").withColumn("drift_words", F.array_join("drift_words", ","))


@query("affected_units", "U7 G18 J5", recursive(*UNITS, *SPANS, select="SELECT DISTINCT doc_id, unit_no FROM sp WHERE type = 'Q≠M≠C'"))
def _(spark, sf):
    return spans.affected_units(divergences(spark, sf, contexts=False, keep_unpaged=False), BOOK)


@query("adjudication_requests", "U6 G14")
def _(spark, sf):
    rows = spans.by_unit(divergences(spark, sf, keep_unpaged=False), BOOK)
    return rows.select(*KEYS, "n_spans", F.to_json("spans").alias("request"))


@query("adjudicated_corrections", "R6 J15 N24 G7")
def _(spark, sf):
    requests = spans.by_unit(divergences(spark, sf, keep_unpaged=False), BOOK)
    # replies derived from the requests: span numbers with letters in turn
    letters = F.array(*[F.lit(x) for x in "ABCU"])
    said = F.transform("spans", lambda s, i: F.concat((i + 1).cast("string"), F.lit(":"), F.element_at(letters, ((F.col("doc_id") + i) % 4 + 1).cast("int"))))
    replies = requests.select(*KEYS, F.array_join(said, " ").alias("raw"))
    return rules.adjudicated(rules.verdict_rows(requests, replies, BOOK), BOOK)


@query("uncertain_pages", "U1 U2 J14 G14 G15 S17 D19")
def _(spark, sf):
    flags = spans.page_flags(spans.high_severity(divergences(spark, sf, contexts=False, keep_unpaged=False)), BOOK)
    rows = spans.mark_pages(pages(spark, sf).select("doc_id", "page_number"), flags, BOOK)
    return rows.select("doc_id", "page_number", F.coalesce("_uncertain", F.lit(False)).alias("uncertain"), F.to_json("_uncertain_spans").alias("spans"))


@query("uncertainty_index", "S17 G15 D19")
def _(spark, sf):
    rows = structured.uncertainty_index(spans.high_severity(divergences(spark, sf, contexts=False, keep_unpaged=False)), BOOK)
    return rows.select("doc_id", "total_high_severity_spans", "index_json")


@query("uncertainty_appendix", "U5")
def _(spark, sf):
    flags = spans.page_flags(spans.high_severity(divergences(spark, sf, contexts=False, keep_unpaged=False)), BOOK)
    return spans.appendix(spans.mark_pages(pages(spark, sf).select("doc_id", "page_number"), flags, BOOK), BOOK)


@query("rule_base_outvoted", "R1 A6")
def _(spark, sf):
    return rules.base_outvoted(aligned(spark, sf, keep_unpaged=False), BOOK, PARAMS).withColumn("pages", F.to_json("pages"))


@query("rule_reading_outvoted", "R2 A6 P31")
def _(spark, sf):
    return rules.reading_outvoted(aligned(spark, sf, keep_unpaged=False), BOOK, params=PARAMS).withColumn("pages", F.to_json("pages"))


@query("rule_single_outvoted", "R3 P31")
def _(spark, sf):
    return rules.single_outvoted(aligned(spark, sf, keep_unpaged=False), BOOK, PARAMS).withColumn("pages", F.to_json("pages"))


@query("rule_linebreaks", "R4 P25 N9 D16")
def _(spark, sf):
    return rules.dedup(rules.linebreaks(divergences(spark, sf, contexts=False, keep_unpaged=False), BOOK), ["doc_id", "pages", "old"]).withColumn("pages", F.to_json("pages"))


@query("rule_formats", "R5 P26")
def _(spark, sf):
    found = rules.formats(divergences(spark, sf, contexts=False, keep_unpaged=False), BOOK)
    return rules.dedup(found.filter(F.col("old").isNotNull() & (F.col("old") != F.col("new"))), ["doc_id", "pages", "old", "new"]).withColumn("pages", F.to_json("pages"))


@query("rule_fourth_reading", "R7 P29 A3 A5")
def _(spark, sf):
    votes = rules.fourth_votes(divergences(spark, sf, contexts=False, fourth=True, keep_unpaged=False))
    return rules.fourth_corrections(votes, BOOK).withColumn("pages", F.to_json("pages"))


@query("corrected_regions", "R1 R8 G17 S16 D22")
def _(spark, sf):
    """Outcome of every rule-1 correction, folded into the text of its pages."""
    from variorum.operators import apply

    fixes = rules.base_outvoted(aligned(spark, sf, keep_unpaged=False), BOOK, PARAMS)
    region = pages(spark, sf, "c", moving=True).withColumn("unit_no", (F.floor((F.col("page_number") - 1) / 2) + 1).cast("int"))
    texts = region.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("page_number", "text"))).alias("_p")).select(*KEYS, F.array_join("_p.text", "\n").alias("text"))
    done = apply.exact_once(texts, fixes, KEYS, order=["seq"])
    return apply.audit(done, KEYS)


@query("base_transplant", "R16 A7 N18 P35 J13")
def _(spark, sf):
    base = pages(spark, sf, "c", moving=True)
    items = F.transform(F.split("text", "\n"), lambda t: F.struct(F.lit("paragraph").alias("type"), t.alias("text")))
    m = units(spark, sf, "m", moving=True)
    done = fallback.transplant(base.select("doc_id", "page_number", items.alias("content_blocks")), page_index(m, BOOK), m, BOOK, PARAMS)
    # a plain explode asks first, below the shuffle of the pages, whether there are blocks, and aligns them for it
    rows = done.select("doc_id", "page_number", F.posexplode_outer("content_blocks").alias("block_idx", "b")).filter(F.col("block_idx").isNotNull())
    return rows.select("doc_id", "page_number", "block_idx", "b.text", F.round("b.confidence", 6).alias("confidence"), "b.fallback", "b.replaced")


def _fallback_blocks(spark, sf):
    """Lines of the third reading, shuffled where they are short, as blocks awaiting a check."""
    base = pages(spark, sf, "c", moving=True)
    return base.select("doc_id", "page_number", F.posexplode(F.split("text", "\n")).alias("block_idx", "text"))


@query("fallback_verify", "R17 A8 A9 P30 P35 J6 J7 N2 G20")
def _(spark, sf):
    q = units(spark, sf, "q", moving=True)
    near = fallback.nearest_unit(pages(spark, sf).select("doc_id", "page_number"), page_index(q, BOOK), BOOK)
    from variorum.sources.unit_log import reference_text

    cleaned = q.withColumn("content", fallback.reference_words(reference_text(F.col("content"), PARAMS.running_titles, page_markers=True, allcaps=True)))
    done = fallback.verify(_fallback_blocks(spark, sf), fallback.beside(cleaned, BOOK), BOOK, PARAMS, near)
    return done.select("doc_id", "page_number", "block_idx", "status", "reject_reason", F.round("confidence", 6).alias("confidence"), "text")


@query("fallback_recover", "R18 J10 O6 P20 N16 N32")
def _(spark, sf):
    m = units(spark, sf, "m", moving=True)
    near = fallback.nearest_unit(pages(spark, sf).select("doc_id", "page_number"), page_index(m, BOOK), BOOK)
    texts = m.withColumn("content", fallback.reread_paragraphs(F.regexp_replace("content", "\n", "\n\n"), PARAMS))
    around = fallback.beside(texts, BOOK).select("doc_id", "unit_no", F.flatten("contents").alias("paras"))
    done = fallback.recover(_fallback_blocks(spark, sf), around, BOOK, PARAMS, near)
    return done.select("doc_id", "page_number", "block_idx", "status", "text", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("prec"))


@query("boundary_overlap", "A4 A11 O7 K1")
def _(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id").orderBy("page_number")
    rows = pages(spark, sf).select("doc_id", "page_number", T.tokens_latin(F.col("text")).alias("head"), T.tokens_latin(F.lag("text").over(w)).alias("tail"))
    rows = spans.spread(rows.filter(F.col("tail").isNotNull()), ["doc_id", "page_number"])
    rows = rows.withColumn("o", dedup.boundary_overlap(F.col("tail"), F.col("head"), PARAMS))
    return rows.select("doc_id", "page_number", "o.head_start", "o.match_len")


@query("page_deduplication", "K1 K2 K3 W13 N33")
def _(spark, sf):
    item = F.struct("block_idx", "type", "text")
    rows = line_blocks(spark, sf).groupBy("doc_id", "page_rank").agg(F.sort_array(F.collect_list(item)).alias("content_blocks"))
    done = dedup.deduplicate(rows, BOOK, PARAMS)
    return done.select("doc_id", "page_rank", "action", "n_trimmed", F.to_json("content_blocks").alias("blocks"))


@query("page_compare", "P22 A2 J3 G1 S14", recursive(*PAGES, select="""
SELECT doc_id, page_number, CASE WHEN len(w1) = 0 AND len(w2) = 0 THEN 'good_match' WHEN len(w1) = 0 OR len(w2) = 0 OR r < 0.7 THEN 'significant_divergence'
  WHEN r >= 0.92 THEN 'good_match' ELSE 'minor_divergence' END AS status, round(coalesce(r, CASE WHEN len(w1) = 0 AND len(w2) = 0 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS ratio
FROM (SELECT pw.*, CASE WHEN len(w1) > 0 AND len(w2) > 0 THEN 2.0 * coalesce(n, 0) / (len(w1) + len(w2)) END AS r FROM pw LEFT JOIN (SELECT k, sum(n) AS n FROM pg_mb GROUP BY k) USING (k))"""))
def _(spark, sf):
    rows = score.compare_pages(pages(spark, sf, "q", moving=True), pages(spark, sf, "m", moving=True), BOOK, PARAMS)
    return rows.select("doc_id", "page_number", "status", F.round("ratio", 6).alias("ratio"))


@query("page_diff", "A13", recursive(*PAGES, """
seg AS (SELECT k, op_no, 0 AS h, CASE tag WHEN 'equal' THEN 'match' ELSE 'del' END AS kind, array_to_string(w1[i1 + 1:i2], ' ') AS words FROM pg_ops JOIN pb USING (k) WHERE i2 > i1
  UNION ALL SELECT k, op_no, 1, 'ins', array_to_string(w2[j1 + 1:j2], ' ') FROM pg_ops JOIN pb USING (k) WHERE tag <> 'equal' AND j2 > j1)""", select="""
SELECT doc_id, page_number, CAST(row_number() OVER (PARTITION BY k ORDER BY op_no, h) - 1 AS INTEGER) AS seg_no, kind, words FROM seg JOIN pb USING (k)"""))
def _(spark, sf):
    rows = score.compare_pages(pages(spark, sf, "q", moving=True), pages(spark, sf, "m", moving=True), BOOK, PARAMS)
    return score.page_diff(rows, BOOK)


def _two_generations(spark, sf):
    """Two readings of every document."""
    from variorum.plans.corpus import reading_lines

    return dealt(spark, sf).select("doc_id", F.array_join(reading_lines("q", True), "\n").alias("first"), F.array_join(reading_lines("m", True), "\n").alias("second"))


@query("content_diff", "A12 P23 G3 N19 D18 S15")
def _(spark, sf):
    rows = score.content_diff(_two_generations(spark, sf), "first", "second", BOOK, PARAMS)
    return rows.select("doc_id", "tag", "t1", "t2", "pre", "post", "t1_pos", T.position_pct(F.col("t1_pos"), F.col("t1_len")).alias("pct"))


@query("content_diff_counts", "G3")
def _(spark, sf):
    rows = score.content_diff(_two_generations(spark, sf), "first", "second", BOOK, PARAMS, contexts=False)
    return rows.groupBy("tag").agg(F.count("*").alias("n"))


@query("content_diff_lines", "S15 W18")
def _(spark, sf):
    from pyspark.sql import Window

    rows = score.content_diff(_two_generations(spark, sf), "first", "second", BOOK, PARAMS)
    rows = rows.withColumn("no", F.row_number().over(Window.partitionBy("doc_id").orderBy("t1_pos", "t2")))
    pct = T.position_pct(F.col("t1_pos"), F.col("t1_len"))
    return rows.select("doc_id", "no", structured.finding_line(F.col("no"), F.col("tag"), pct, F.col("t1"), F.col("t2"), F.col("pre"), F.col("post")).alias("line"))


@query("anchored_diff", "A12")
def _(spark, sf):
    noise = "^$"
    texts = _two_generations(spark, sf).select("doc_id", T.tokens_ascii(F.col("first"), noise).alias("l"), T.tokens_ascii(F.col("second"), noise).alias("r"))
    return score.anchored_opcodes(score.anchored_chunks(texts, "l", "r", BOOK), BOOK)


@query("agreement_buckets", "G16 A2 J12 P34 D17 S5")
def _(spark, sf):
    buckets = score.bucket_bounds(pages(spark, sf, "c", moving=True), BOOK, PARAMS)
    q, m = (score.stream_of(units(spark, sf, r, moving=True), BOOK, PARAMS) for r in "qm")
    rows = score.agreement(buckets, q, m, BOOK, PARAMS)
    return rows.select("doc_id", "bucket", "c_words", *[F.round(c, 6).alias(c) for c in ("cq", "cm", "qm")], "flagged", "band")


@query("chapter_fuzzy_match", "P8 P9 A10")
def _(spark, sf):
    """Headings and running headers found in lines that were misread by a character or two."""
    names = [*[c.heading for c in PARAMS.chapters], *PARAMS.running_titles]
    h = (F.col("doc_id") * 7 + F.col("line_no")) % (len(names) * 3)
    misread = F.element_at(F.array(*[F.lit(n) for n in names]), (h % len(names) + 1).cast("int"))
    misread = F.when(h % 3 == 0, misread).when(h % 3 == 1, F.translate(misread, "EN", "FM")).otherwise(F.concat(F.lit("I"), misread))
    rows = lines(spark, sf).select("doc_id", "line_no", misread.alias("line"))
    rows = rows.withColumn("chapter", assemble.match_chapter(F.col("line"), PARAMS)).withColumn("header", assemble.is_running_header(F.col("line"), PARAMS))
    return rows


@query("run_summary", "G20 G17")
def _(spark, sf):
    q = units(spark, sf, "q", moving=True)
    near = fallback.nearest_unit(pages(spark, sf).select("doc_id", "page_number"), page_index(q, BOOK), BOOK)
    words = q.withColumn("content", fallback.reference_words(F.col("content")))
    done = fallback.verify(_fallback_blocks(spark, sf), fallback.beside(words, BOOK), BOOK, PARAMS, near)
    return fallback.run_summary(done, "status", ["verified", "corrected", "unverified"])
