"""Joins, set operations, counts over keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from variorum.functions import predicates as P
from variorum.functions import text as T
from variorum.operators import dedup, fallback, score, spans
from variorum.plans.corpus import PARAMS, SQL_LINES, documents, lines, pages, sql, sql_pages, sql_units, table, units
from variorum.plans.registry import query
from variorum.sources import unit_log

BOOK = ("doc_id",)


@query("unit_inner_join", "J1 T2 D3", sql(SQL_LINES, sql_pages("lines", "p"), sql_units("p", "u"), select="""
SELECT u.doc_id, u.unit_no, length(u.content) AS q_chars, CAST(length(u.content) - length(replace(u.content, ',', '')) AS BIGINT) AS n_commas
FROM u JOIN labels l ON l.doc_id = u.doc_id AND l.quality = 1"""))
def _(spark, sf):
    # one reading covers every document, the other those labelled good
    good = table(spark, sf, "labels").filter("quality = 1").select("doc_id")
    q = units(spark, sf).select("doc_id", "unit_no", "content")
    m = q.join(good, "doc_id", "left_semi").withColumn("content", F.replace("content", F.lit(","), F.lit("")))
    rows = spans.pair_units(q, m, BOOK)
    return rows.select("doc_id", "unit_no", F.length("q_raw").cast("bigint").alias("q_chars"), (F.length("q_raw") - F.length("m_raw")).cast("bigint").alias("n_commas"))


def _generations(spark, sf):
    """Two generations of pages: one lacks the French texts, the other the German ones."""
    rows = pages(spark, sf).join(documents(spark, sf).select("doc_id", "lang"), "doc_id", "inner")
    return rows.filter("lang <> 'fr'"), rows.filter("lang <> 'de'")


_GEN = ("g1 AS (SELECT p.* FROM p JOIN documents d USING (doc_id) WHERE lang <> 'fr')", "g2 AS (SELECT p.* FROM p JOIN documents d USING (doc_id) WHERE lang <> 'de')")


@query("page_full_outer", "J3 J4 T1 P22", sql(SQL_LINES, sql_pages("lines", "p"), *_GEN, select="""
SELECT doc_id, page_number, CASE WHEN g1.text IS NULL THEN 'orphan_t2_only' WHEN g2.text IS NULL THEN 'orphan_t1_only' ELSE 'good_match' END AS status
FROM g1 FULL JOIN g2 USING (doc_id, page_number)"""))
def _(spark, sf):
    a, b = _generations(spark, sf)
    return score.compare_pages(a, b, BOOK, PARAMS).select("doc_id", "page_number", "status")


@query("page_status_counts", "G1 G2", sql(SQL_LINES, sql_pages("lines", "p"), *_GEN, """
s AS (SELECT CASE WHEN g1.text IS NULL THEN 'orphan_t2_only' WHEN g2.text IS NULL THEN 'orphan_t1_only' ELSE 'good_match' END AS status FROM g1 FULL JOIN g2 USING (doc_id, page_number)),
dom AS (SELECT unnest(['good_match', 'minor_divergence', 'significant_divergence', 'one_side_missing', 'orphan_t1_only', 'orphan_t2_only']) AS status)""", select="""
SELECT dom.status, count(s.status) AS n FROM dom LEFT JOIN s USING (status) GROUP BY dom.status"""))
def _(spark, sf):
    a, b = _generations(spark, sf)
    return score.status_counts(score.compare_pages(a, b, BOOK, PARAMS))


@query("page_orphans", "J4 T6", sql(SQL_LINES, sql_pages("lines", "p"), *_GEN, select="""
SELECT 'first only' AS side, doc_id, page_number FROM g1 WHERE NOT EXISTS (SELECT 1 FROM g2 WHERE g2.doc_id = g1.doc_id AND g2.page_number = g1.page_number)
UNION ALL SELECT 'second only', doc_id, page_number FROM g2 WHERE NOT EXISTS (SELECT 1 FROM g1 WHERE g1.doc_id = g2.doc_id AND g1.page_number = g2.page_number)"""))
def _(spark, sf):
    a, b = (x.select("doc_id", "page_number") for x in _generations(spark, sf))
    keys = ["doc_id", "page_number"]
    first = a.join(b, keys, "left_anti").select(F.lit("first only").alias("side"), *keys)
    return first.unionByName(b.join(a, keys, "left_anti").select(F.lit("second only").alias("side"), *keys))


@query("affected_units_semi", "J5", sql(SQL_LINES, sql_pages("lines", "p"), sql_units("p", "u"), select="""
SELECT doc_id, unit_no FROM u WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = u.doc_id AND l.toxic = 1)"""))
def _(spark, sf):
    bad = table(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    return units(spark, sf).select("doc_id", "unit_no").join(bad, "doc_id", "left_semi")


# pages known to a reading: of every document those whose text has no bar, so gaps are where tables stand
_KNOWN = "k AS (SELECT doc_id, page_number, CAST((page_number - 1) // 2 + 1 AS INTEGER) AS unit_no FROM p WHERE text NOT LIKE '%ing%the%')"


@query("nearest_unit", "J6", sql(SQL_LINES, sql_pages("lines", "p"), _KNOWN, """
c AS (SELECT p.doc_id, p.page_number, k.unit_no, list_position([0, -1, 1, -2, 2], k.page_number - p.page_number) - 1 AS priority
  FROM p JOIN k ON k.doc_id = p.doc_id AND k.page_number BETWEEN p.page_number - 2 AND p.page_number + 2)""", select="""
SELECT doc_id, page_number, arg_min(unit_no, priority) AS unit_no, CAST(min(priority) AS INTEGER) AS priority FROM c GROUP BY doc_id, page_number"""))
def _(spark, sf):
    p = pages(spark, sf)
    known = p.filter(~F.col("text").like("%ing%the%")).select("doc_id", "page_number", (F.floor((F.col("page_number") - 1) / 2) + 1).cast("int").alias("unit_no"))
    return fallback.nearest_unit(p.select("doc_id", "page_number"), known, BOOK)


@query("adjacent_units", "J7", sql(SQL_LINES, sql_pages("lines", "p"), sql_units("p", "u"), """
w AS (SELECT doc_id, page_number, CAST((page_number - 1) // 2 + 1 AS INTEGER) AS unit_no FROM p)""", select="""
SELECT w.doc_id, w.page_number, string_agg(u.content, ' ' ORDER BY u.unit_no) AS reference, count(*) AS n_units
FROM w JOIN u ON u.doc_id = w.doc_id AND u.unit_no BETWEEN w.unit_no - 1 AND w.unit_no + 1 GROUP BY w.doc_id, w.page_number"""))
def _(spark, sf):
    placed = pages(spark, sf).select("doc_id", "page_number", (F.floor((F.col("page_number") - 1) / 2) + 1).cast("int").alias("unit_no"))
    rows = fallback.adjacent(placed, units(spark, sf), BOOK)
    return rows.select("doc_id", "page_number", F.array_join("contents", " ").alias("reference"), F.size("unit_nos").cast("bigint").alias("n_units"))


def line_blocks(spark, sf):
    rows = lines(spark, sf)
    return rows.select("doc_id", F.floor(F.col("line_no") / 5).cast("int").alias("page_rank"), (F.col("line_no") % 5).alias("block_idx"), F.lit("paragraph").alias("type"), F.col("line").alias("text"))


_LAT = "regexp_extract_all(lower(line), '[a-zA-ZÀ-ÿ''’-]+')"
_PAIRS = f"""t AS (SELECT doc_id, CAST(line_no // 5 AS INTEGER) AS r, line_no % 5 AS i, line, len({_LAT}) AS n, list_distinct({_LAT}) AS s FROM lines),
pr AS (SELECT b.doc_id, b.r AS b_rank, b.i AS b_idx, a.r AS a_rank, a.i AS a_idx, len(list_intersect(a.s, b.s)) / greatest(len(a.s), len(b.s)) AS similarity
  FROM t b JOIN t a ON a.doc_id = b.doc_id AND a.r BETWEEN b.r - 3 AND b.r - 1 WHERE b.n >= 15)"""


@query("lookback_duplicates", "J8 K2 N15", sql(SQL_LINES, _PAIRS, select="SELECT doc_id, b_rank, b_idx, a_rank, a_idx, round(similarity, 6) AS similarity FROM pr WHERE similarity >= 0.72"))
def _(spark, sf):
    return dedup.lookback_pairs(line_blocks(spark, sf), BOOK, PARAMS).withColumn("similarity", F.round("similarity", 6))


@query("duplicate_block_removal", "K2 T6", sql(SQL_LINES, _PAIRS, select="""
SELECT t.doc_id, t.r AS page_rank, t.i AS block_idx, t.line AS text FROM t
WHERE NOT EXISTS (SELECT 1 FROM pr WHERE pr.doc_id = t.doc_id AND pr.b_rank = t.r AND pr.b_idx = t.i AND pr.similarity >= 0.72)"""))
def _(spark, sf):
    blocks = line_blocks(spark, sf)
    return dedup.duplicate_blocks(dedup.lookback_pairs(blocks, BOOK, PARAMS), blocks, BOOK).drop("type")


@query("ngram_loop", "G9 O5 X4", """
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 8], ' ') AS phrase FROM (SELECT doc_id, w, unnest(range(len(w) - 7)) AS i FROM w)),
c AS (SELECT doc_id, phrase, count(*) AS n, min(i) AS pos FROM g GROUP BY doc_id, phrase HAVING count(*) >= 3)
SELECT doc_id, phrase, n FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, pos) = 1""")
def _(spark, sf):
    return dedup.repetition_loop(documents(spark, sf), "text", BOOK, PARAMS)


@query("ngram_repeat_in_page", "W14 O8", sql(SQL_LINES, sql_pages("lines", "p"), """
w AS (SELECT doc_id, page_number, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT doc_id, page_number, CAST(i AS INTEGER) AS pos, array_to_string(w[i + 1:i + 10], ' ') AS phrase FROM (SELECT doc_id, page_number, w, unnest(range(len(w) - 10)) AS i FROM w)),
d AS (SELECT *, pos - lag(pos) OVER (PARTITION BY doc_id, page_number, phrase ORDER BY pos) AS dist FROM g)""", select="""
SELECT doc_id, page_number, phrase, pos FROM d WHERE dist > 5 QUALIFY row_number() OVER (PARTITION BY doc_id, page_number ORDER BY pos) = 1"""))
def _(spark, sf):
    return dedup.repeated_phrase(pages(spark, sf), "text", ["doc_id", "page_number"], PARAMS)


@query("bucket_fraction", "G16 W12 J12", sql(SQL_LINES, sql_pages("lines", "p"), """
t AS (SELECT p.doc_id, page_number, page_number // 4 * 0 + (page_number - 1) // 4 AS bucket, len(list_filter(regexp_extract_all(lower(regexp_replace(strip_accents(replace(replace(text, '—', ' '), '–', ' ')), '[^\\x00-\\x7F]', '', 'g')), '\\b[a-z'']+\\b'), lambda x: true)) AS n FROM p),
b AS (SELECT doc_id, bucket, sum(n) AS n, min(page_number) AS page_from, max(page_number) AS page_to FROM t GROUP BY doc_id, bucket),
c AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY doc_id ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER (PARTITION BY doc_id) AS total FROM b)""", select="""
SELECT doc_id, CAST(bucket AS INTEGER) AS bucket, page_from, page_to, CAST(before AS BIGINT) AS words_before, CAST(total AS BIGINT) AS total_words,
  CASE WHEN total > 0 THEN round(before / total, 6) ELSE 0.0 END AS frac_start FROM c"""))
def _(spark, sf):
    # lines of bracketed notes or rules do not occur in the plain text, so both sides count every word
    rows = score.bucket_bounds(pages(spark, sf), BOOK, PARAMS)
    return rows.select("doc_id", "bucket", F.col("page_from").cast("int").alias("page_from"), F.col("page_to").cast("int").alias("page_to"), "words_before", "total_words", F.round("frac_start", 6).alias("frac_start"))


@query("stream_offsets", "S5 W11 O1", """
WITH t AS (SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS INTEGER) AS n_tokens FROM documents)
SELECT doc_id, source, n_tokens, CAST(coalesce(sum(n_tokens) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_token FROM t""")
def _(spark, sf):
    rows = unit_log.stream_offsets(documents(spark, sf).select("doc_id", "source", "text"), T.tokens_ws(F.col("text")), ["source"], "doc_id", 2048)
    return rows.select("doc_id", "source", "n_tokens", "start_token")


@query("score_bands", "P34", """
WITH t AS (SELECT a.conv_id, a.turn, list_distinct(regexp_extract_all(lower(a.text), '[a-zA-ZÀ-ÿ''’-]+')) AS x, list_distinct(regexp_extract_all(lower(b.text), '[a-zA-ZÀ-ÿ''’-]+')) AS y
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
s AS (SELECT CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 ELSE len(list_intersect(x, y)) / greatest(len(x), len(y)) END AS s FROM t)
SELECT CASE WHEN s < 0.80 THEN 'red' WHEN s < 0.90 THEN 'orange' ELSE 'green' END AS band, count(*) AS n FROM s GROUP BY 1""")
def _(spark, sf):
    from variorum.plans.text_queries import _turn_pairs

    a, b = (F.array_distinct(T.tokens_latin(F.col(c))) for c in ("a", "b"))
    return _turn_pairs(spark, sf).select(P.score_band(T.overlap_similarity(a, b)).alias("band")).groupBy("band").agg(F.count("*").alias("n"))
