"""Guarded corrections, patches and deletions."""

from __future__ import annotations

from pyspark.sql import functions as F

from variorum.functions import text as T
from variorum.operators import apply, review, rules
from variorum.plans.corpus import SQL_LINES, documents, lines, pages, sql, sql_pages, table
from variorum.plans.registry import query

KEYS = ["doc_id", "page_number"]


def _fixes(spark, sf):
    """Two corrections per page: the second word of the first line, then the last word of the last line."""
    w = T.tokens_ws(F.col("text"))
    rows = pages(spark, sf).select(*KEYS, w.alias("w")).filter(F.size("w") >= 2)
    both = F.array(
        F.struct(F.lit(1).alias("seq"), F.get("w", F.lit(1)).alias("old"), F.concat(F.get("w", F.lit(1)), F.lit("-1")).alias("new")),
        F.struct(F.lit(2).alias("seq"), F.element_at("w", -1).alias("old"), F.lit("END").alias("new")),
    )
    return rows.select(*KEYS, F.explode(both).alias("f")).select(*KEYS, "f.*")


_W = "list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')"
_SQL_FIX = (SQL_LINES, sql_pages("lines", "p"), f"w AS (SELECT doc_id, page_number, text, {_W} AS w FROM p)", """
c1 AS (SELECT *, w[2] AS o1, w[-1] AS o2 FROM w),
c2 AS (SELECT *, CASE WHEN len(w) >= 2 THEN CAST((length(text) - length(replace(text, o1, ''))) / length(o1) AS INTEGER) END AS n1 FROM c1),
c3 AS (SELECT *, CASE WHEN n1 = 1 THEN replace(text, o1, o1 || '-1') ELSE text END AS t1 FROM c2),
c4 AS (SELECT *, CASE WHEN len(w) >= 2 THEN CAST((length(t1) - length(replace(t1, o2, ''))) / length(o2) AS INTEGER) END AS n2 FROM c3),
c5 AS (SELECT *, CASE WHEN n2 = 1 THEN replace(t1, o2, 'END') ELSE t1 END AS t2 FROM c4)""")


def _applied(spark, sf):
    return apply.exact_once(pages(spark, sf), _fixes(spark, sf), KEYS, order=["seq"])


@query("exact_once_replace", "R8 D15", sql(*_SQL_FIX, select="SELECT doc_id, page_number, t2 AS text FROM c5"))
def _(spark, sf):
    return _applied(spark, sf).select(*KEYS, "text")


@query("correction_audit", "G17 S16 D22", sql(*_SQL_FIX, """
h AS (SELECT n1 AS n FROM c5 WHERE len(w) >= 2 UNION ALL SELECT n2 FROM c5 WHERE len(w) >= 2)""", select="""
SELECT CASE WHEN n = 1 THEN 'applied' WHEN n = 0 THEN 'skipped_absent' ELSE 'skipped_ambiguous' END AS action, count(*) AS n FROM h GROUP BY 1"""))
def _(spark, sf):
    return apply.audit(_applied(spark, sf), KEYS).groupBy("action").agg(F.count("*").alias("n"))


@query("exact_once_document", "R9", """
WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')[1] AS o FROM documents)
SELECT doc_id, CASE WHEN (length(text) - length(replace(text, o, ''))) / length(o) = 1 THEN replace(text, o, 'FIRST') ELSE text END AS text FROM w""")
def _(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    fixes = docs.select("doc_id", F.lit(1).alias("seq"), F.get(T.tokens_ws(F.col("text")), F.lit(0)).alias("old"), F.lit("FIRST").alias("new"))
    return apply.exact_once(docs, fixes, ["doc_id"], order=["seq"]).select("doc_id", "text")


# a list of corrections per document: one that may be there, some that are not, one that another makes, one at the start
_MANY = ("w[3] || ' ' || w[4]", "w[4] || 'NEW'"), ("'no ' || w[1] || ' such ' || w[2]", "'x'"), ("w[2] || 'QZX'", "'y'"), ("w[4] || 'NEW'", "'MADE ' || w[1]"), ("w[1]", "'FIRST'")


def _many(words: str, keys, df):
    """The same list as rows: seq, old, new."""
    at = lambda i: F.get(words, F.lit(i - 1))
    pairs = (
        (F.concat(at(3), F.lit(" "), at(4)), F.concat(at(4), F.lit("NEW"))),
        (F.concat(F.lit("no "), at(1), F.lit(" such "), at(2)), F.lit("x")),
        (F.concat(at(2), F.lit("QZX")), F.lit("y")),
        (F.concat(at(4), F.lit("NEW")), F.concat(F.lit("MADE "), at(1))),
        (at(1), F.lit("FIRST")),
    )
    listed = F.array(*(F.struct(F.lit(k + 1).alias("seq"), o.alias("old"), n.alias("new")) for k, (o, n) in enumerate(pairs)))
    return df.select(*keys, F.explode(listed).alias("f")).select(*keys, "f.*")


def _sql_many_once() -> str:
    steps = ["m0 AS (SELECT doc_id, text AS t, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w, '' AS hits FROM documents)"]
    for k, (old, new) in enumerate(_MANY):
        steps.append(f"n{k} AS (SELECT *, {old} AS o, {new} AS r FROM m{k})")
        steps.append(f"c{k} AS (SELECT *, CASE WHEN coalesce(trim(o), '') = '' OR coalesce(trim(r), '') = '' THEN -1 ELSE CAST((length(t) - length(replace(t, o, ''))) / length(o) AS INTEGER) END AS n FROM n{k})")
        steps.append(f"m{k + 1} AS (SELECT doc_id, CASE WHEN n = 1 THEN replace(t, o, r) ELSE t END AS t, w, hits || CASE WHEN text_is_null THEN '' ELSE n || ',' END AS hits FROM (SELECT *, t IS NULL AS text_is_null FROM c{k}))")
    return sql(*steps, select=f"SELECT doc_id, t AS text, hits FROM m{len(_MANY)}")


@query("exact_once_many", "R9 G17", _sql_many_once())
def _(spark, sf):
    """Documents after a list of corrections of which most have no place in them, found by an index of the text."""
    docs = documents(spark, sf).select("doc_id", "text").withColumn("w", T.tokens_ws(F.col("text")))
    done = apply.exact_once(docs.select("doc_id", "text"), _many("w", ["doc_id"], docs), ["doc_id"], order=["seq"], indexed=True)
    hits = F.when(F.col("text").isNull(), "").otherwise(F.array_join(F.transform("hits", lambda n: F.concat(n.cast("string"), F.lit(","))), ""))
    return done.select("doc_id", "text", hits.alias("hits"))


def _sql_many_blocks() -> str:
    steps = [SQL_LINES, "m0 AS (SELECT l.doc_id, line_no, line AS t, list_filter(regexp_split_to_array(d.text, '\\s+'), lambda x: x <> '') AS w FROM lines l JOIN documents d USING (doc_id))"]
    for k, (old, new) in enumerate(_MANY):
        steps.append(f"n{k} AS (SELECT *, {old} AS o, {new} AS r FROM m{k})")
        steps.append(f"c{k} AS (SELECT *, coalesce(trim(o), '') <> '' AND coalesce(trim(r), '') <> '' AND contains(t, o) AS has FROM n{k})")
        steps.append(f"k{k} AS (SELECT *, count(*) FILTER (has) OVER (PARTITION BY doc_id) AS n FROM c{k})")
        steps.append(f"m{k + 1} AS (SELECT doc_id, line_no, w, CASE WHEN n = 1 AND has THEN substring(t, 1, instr(t, o) - 1) || r || substring(t, instr(t, o) + length(o)) ELSE t END AS t FROM k{k})")
    return sql(*steps, select=f"SELECT doc_id, line_no AS block_idx, t AS text FROM m{len(_MANY)}")


@query("one_block_many", "R11 J9", _sql_many_blocks())
def _(spark, sf):
    """The same list where a correction fires if exactly one line of the document has its phrase."""
    docs = documents(spark, sf).filter(F.col("text").isNotNull()).select("doc_id", T.tokens_ws(F.col("text")).alias("w"))
    rows = lines(spark, sf).select("doc_id", F.col("line_no").alias("block_idx"), F.col("line").alias("text"))
    done = apply.one_block(rows, _many("w", ["doc_id"], docs), ["doc_id"], order=["seq"], block_order=["block_idx"], indexed=True)
    out = done.select("doc_id", F.explode(F.arrays_zip(F.col("places").alias("p"), F.col("texts").alias("text"))).alias("z"))
    return out.select("doc_id", "z.p.block_idx", "z.text")


def _sql_one_block(scope: str) -> str:
    return sql(SQL_LINES, f"""
b AS (SELECT doc_id, CAST(line_no // 5 + 1 AS INTEGER) AS page_number, line_no % 5 AS i, line FROM lines),
f AS (SELECT {scope}, list_filter(regexp_split_to_array(arg_min(line, page_number * 1000 + i), '\\s+'), lambda x: x <> '')[1] AS o FROM b GROUP BY {scope}),
n AS (SELECT {scope}, o, count(*) FILTER (contains(line, o)) AS k FROM b JOIN f USING ({scope}) GROUP BY {scope}, o)""", select=f"""
SELECT b.doc_id, b.page_number, b.i AS block_idx, CASE WHEN n.k = 1 AND contains(b.line, n.o) THEN substring(b.line, 1, instr(b.line, n.o) - 1) || 'ONE' || substring(b.line, instr(b.line, n.o) + length(n.o)) ELSE b.line END AS text
FROM b LEFT JOIN n USING ({scope})""")


def _one_block(spark, sf, scope):
    rows = lines(spark, sf).select("doc_id", (F.floor(F.col("line_no") / 5) + 1).cast("int").alias("page_number"), (F.col("line_no") % 5).alias("block_idx"), F.col("line").alias("text"))
    first = rows.groupBy(*scope).agg(F.min_by("text", F.struct("page_number", "block_idx")).alias("t"))
    fixes = first.select(*scope, F.lit(1).alias("seq"), F.get(T.tokens_ws(F.col("t")), F.lit(0)).alias("old"), F.lit("ONE").alias("new"))
    order = [c for c in ("page_number", "block_idx") if c not in scope]
    done = apply.one_block(rows, fixes, scope, order=["seq"], block_order=order)
    out = done.select(*scope, F.explode(F.arrays_zip(F.col("places").alias("p"), F.col("texts").alias("text"))).alias("z"))
    return out.select(*scope, *[F.col(f"z.p.{c}").alias(c) for c in order], F.col("z.text").alias("text"))


@query("one_block_replace", "R10 J9", _sql_one_block("doc_id, page_number"))
def _(spark, sf):
    return _one_block(spark, sf, ["doc_id", "page_number"])


@query("one_block_document", "R11 J9", _sql_one_block("doc_id"))
def _(spark, sf):
    return _one_block(spark, sf, ["doc_id"])


_PATCHES = (("the ", "THE ", "article"), ("THE a", "THE A", "after"), (", ", "; ", "comma"))


@query("patch_first", "R12", sql(SQL_LINES, """
a AS (SELECT *, contains(line, 'the ') AS p1, CASE WHEN contains(line, 'the ') THEN substring(line, 1, instr(line, 'the ') - 1) || 'THE ' || substring(line, instr(line, 'the ') + 4) ELSE line END AS l1 FROM lines),
b AS (SELECT *, contains(l1, 'THE a') AS p2, CASE WHEN contains(l1, 'THE a') THEN substring(l1, 1, instr(l1, 'THE a') - 1) || 'THE A' || substring(l1, instr(l1, 'THE a') + 5) ELSE l1 END AS l2 FROM a),
c AS (SELECT *, contains(l2, ', ') AS p3, CASE WHEN contains(l2, ', ') THEN substring(l2, 1, instr(l2, ', ') - 1) || '; ' || substring(l2, instr(l2, ', ') + 2) ELSE l2 END AS l3 FROM b)""", select="""
SELECT doc_id, line_no, l3 AS line, array_to_string(list_filter([CASE WHEN p1 THEN 'article' END, CASE WHEN p2 THEN 'after' END, CASE WHEN p3 THEN 'comma' END], lambda x: x IS NOT NULL), ',') AS patched FROM c"""))
def _(spark, sf):
    rows = apply.patch_all(lines(spark, sf), "line", _PATCHES)
    return rows.select("doc_id", "line_no", "line", F.array_join("patched", ",").alias("patched"))


# lines are pages here; a sentence that a document holds exactly twice marks the copied passage
_TRIG, _LEAD, _RESUME = "%ing the %", "%tion%", "%was%"


@query("range_delete", "R13 T6", sql(SQL_LINES, f"""
h AS (SELECT doc_id, min(line_no) AS h0, max(line_no) AS h1 FROM lines WHERE line LIKE '{_TRIG}' GROUP BY doc_id HAVING count(*) = 2),
r AS (SELECT h.doc_id, coalesce(max(CASE WHEN line LIKE '{_LEAD}' AND line_no < h1 AND line_no > greatest(h0, h1 - 3) THEN line_no END), any_value(h1)) AS a,
  coalesce(min(CASE WHEN line LIKE '{_RESUME}' AND line_no >= h1 THEN line_no END), 1000000) AS b FROM h JOIN lines USING (doc_id) GROUP BY h.doc_id)""", select="""
SELECT l.doc_id, l.line_no, l.line FROM lines l LEFT JOIN r USING (doc_id) WHERE r.a IS NULL OR NOT (l.line_no >= r.a AND l.line_no < r.b)"""))
def _(spark, sf):
    rows = lines(spark, sf).select("doc_id", "line_no", "line")
    return apply.delete_repeated_range(rows, ["doc_id"], F.col("line").like(_TRIG), F.col("line").like(_LEAD), F.col("line").like(_RESUME), rank="line_no")


@query("text_range_delete", "R14", """
WITH p AS (SELECT doc_id, text, instr(text, 'and') AS pos FROM documents), b AS (SELECT *, CASE WHEN pos > 0 THEN instr(reverse(text[1:pos - 1]), chr(10)) ELSE 0 END AS back,
  CASE WHEN pos > 0 AND instr(text[pos:], chr(10)) > 0 THEN pos + instr(text[pos:], chr(10)) - 1 ELSE 0 END AS stop FROM p)
SELECT doc_id, CASE WHEN pos > 0 AND back > 0 AND stop > 0 THEN text[1:pos - 1 - back] || chr(10) || text[stop + 1:] ELSE text END AS text FROM b""")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", apply.delete_between(F.col("text"), "and", "\n").alias("text"))


@query("replace_pages", "R15 T6 J16", sql(SQL_LINES, sql_pages("lines", "p"), """
g AS (SELECT doc_id FROM labels WHERE quality = 0)""", select="""
SELECT doc_id, page_number, text FROM p WHERE NOT (page_number BETWEEN 1 AND 2 AND doc_id IN (SELECT doc_id FROM g))
UNION ALL SELECT doc_id, 1, 'transcribed by hand' FROM g JOIN documents USING (doc_id)"""))
def _(spark, sf):
    poor = table(spark, sf, "labels").filter("quality = 0").join(documents(spark, sf).select("doc_id"), "doc_id", "left_semi")
    new = poor.select("doc_id", F.lit(1).alias("page_number"), F.lit("transcribed by hand").alias("text"))
    return apply.replace_pages(pages(spark, sf).select(*KEYS, "text"), new, ["doc_id"], 1, 2)


@query("split_at_break", "R15", sql(SQL_LINES, """
k AS (SELECT doc_id, line_no, line LIKE '%!' AS brk FROM lines), f AS (SELECT doc_id, count(*) AS n, min(CASE WHEN brk THEN line_no END) AS pos FROM k GROUP BY doc_id)""", select="""
SELECT doc_id, CAST(coalesce(pos + 1, n) AS INTEGER) AS n_first, CAST(n - coalesce(pos + 1, n) AS INTEGER) AS n_rest FROM f"""))
def _(spark, sf):
    kind = F.when(F.col("line").like("%!"), "section_break").otherwise("paragraph")
    rows = lines(spark, sf).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("line_no", kind.alias("type")))).alias("b"))
    s = apply.split_at_break(F.col("b"))
    return rows.select("doc_id", F.size(s["first"]).alias("n_first"), F.size(s["rest"]).alias("n_rest"))


@query("correction_dedup", "T4", """
WITH c AS (SELECT conv_id, turn, role, split_part(text, ' ', 1) AS old FROM conversations)
SELECT role, old, arg_min(conv_id, conv_id * 1000 + turn) AS conv_id, arg_min(turn, conv_id * 1000 + turn) AS turn FROM c GROUP BY role, old""")
def _(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.split_part("text", F.lit(" "), F.lit(1)).alias("old"))
    return rules.dedup(rows, ["role", "old"], ["conv_id", "turn"]).select("role", "old", "conv_id", "turn")


def _store(spark, sf):
    """Reviews keyed by conversation: every user turn is a save, the first one is the stored one."""
    rows = table(spark, sf, "conversations")
    status = F.when(F.length("text") % 3 == 0, "corrected").when(F.length("text") % 3 == 1, "keep").otherwise("unreviewed")
    saves = rows.select(F.col("conv_id").cast("string").alias("key"), "text", status.alias("status"), F.col("turn").alias("timestamp"))
    return saves.filter("timestamp = 0"), saves.filter("timestamp > 0")


_SQL_STORE = """s AS (SELECT CAST(conv_id AS VARCHAR) AS key, arg_max(text, turn) AS text, max(turn) AS timestamp FROM conversations GROUP BY conv_id),
r AS (SELECT *, CASE length(text) % 3 WHEN 0 THEN 'corrected' WHEN 1 THEN 'keep' ELSE 'unreviewed' END AS status FROM s)"""


@query("review_upsert", "J16 D21", sql(_SQL_STORE, select="SELECT key, text, timestamp, status FROM r"))
def _(spark, sf):
    return review.upsert(*_store(spark, sf)).select("key", "text", "timestamp", "status")


@query("review_export", "S20", sql(_SQL_STORE, select="SELECT key, text, status FROM r WHERE status <> 'unreviewed'"))
def _(spark, sf):
    return review.reviewed(review.upsert(*_store(spark, sf))).select("key", "text", "status")


@query("review_progress", "G21 R20", sql(_SQL_STORE, select="""
SELECT 'open' AS store, count(*) AS total, count(*) FILTER (status <> 'unreviewed') AS reviewed, count(*) FILTER (status = 'corrected') AS corrected FROM r
UNION ALL SELECT 'cleared', 0, 0, 0"""))
def _(spark, sf):
    store = review.upsert(*_store(spark, sf))
    both = review.progress(store).withColumn("store", F.lit("open"))
    return both.unionByName(review.progress(review.cleared(store)).withColumn("store", F.lit("cleared")))
