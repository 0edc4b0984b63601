"""Majority votes over readings whose tokens already stand side by side."""

from __future__ import annotations

from pyspark.sql import functions as F

from variorum.functions import predicates as P
from variorum.functions import text as T
from variorum.operators import review, spans
from variorum.plans.corpus import SQL_LINES, documents, fold, reading_lines, sql, sql_reading_lines
from variorum.plans.registry import query

BOOK = ("doc_id",)


def tokens(spark, sf):
    """doc_id, source, line_no, pos, q, m, c: the three readings token by token."""
    docs = documents(spark, sf).select("doc_id", "source", *[reading_lines(r).alias(r) for r in "qmc"])
    rows = docs.select("doc_id", "source", F.posexplode(F.arrays_zip("q", "m", "c")).alias("line_no", "l"))
    words = F.arrays_zip(*[F.split(F.col(f"l.{r}"), " ").alias(r) for r in "qmc"])
    return rows.select("doc_id", "source", "line_no", F.posexplode(words).alias("pos", "t")).select("doc_id", "source", "line_no", "pos", "t.q", "t.m", "t.c").filter("q <> ''")


_SQL_TOK = (SQL_LINES, *[sql_reading_lines(r) for r in "qmc"], """
tok AS (SELECT doc_id, source, line_no, CAST(unnest(range(len(string_split(q.line, ' ')))) AS INTEGER) AS pos, unnest(string_split(q.line, ' ')) AS q,
  unnest(string_split(m.line, ' ')) AS m, unnest(string_split(c.line, ' ')) AS c FROM l_q q JOIN l_m m USING (doc_id, source, line_no) JOIN l_c c USING (doc_id, source, line_no)),
t AS (SELECT * FROM tok WHERE q <> '')""".strip())

_CLASS = "CASE WHEN q = m AND m = c THEN 'Q=M=C' WHEN q = m THEN 'Q=M≠C' WHEN c = q THEN 'Q=C≠M' WHEN c = m THEN 'M=C≠Q' ELSE 'Q≠M≠C' END"
_MAJ = f"CASE WHEN c = '' THEN 'Q≠M (C n/a)' WHEN {fold('q')} = {fold('m')} THEN 'Q=M' WHEN {fold('c')} = {fold('q')} THEN 'Q=C≠M' WHEN {fold('c')} = {fold('m')} THEN 'M=C≠Q' ELSE 'Q≠M≠C' END"


def _strip(x: str) -> str:
    return f"trim(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'))"


@query("vote_by_position", "P24 G4", sql(*_SQL_TOK, select=f"SELECT source, {_CLASS} AS class, count(*) AS n FROM t GROUP BY ALL"))
def _(spark, sf):
    # grouped on the class itself, so partial counts leave every task, not tokens
    rows = tokens(spark, sf).withColumn("class", P.vote_by_position(F.col("q"), F.col("m"), F.col("c")))
    return rows.groupBy("source", "class").agg(F.count("*").alias("n"))


@query("majority_class", "P24", sql(*_SQL_TOK, select=f"SELECT doc_id, line_no, pos, q, m, c, {_MAJ} AS type FROM t WHERE q <> m"))
def _(spark, sf):
    rows = tokens(spark, sf).filter("q <> m")
    return rows.select("doc_id", "line_no", "pos", "q", "m", "c", P.majority_class(F.col("q"), F.col("m"), F.col("c")).alias("type"))


@query("class_counts", "G4 G5", sql(*_SQL_TOK, f"k AS (SELECT {_MAJ} AS type, count(*) AS n FROM t WHERE q <> m GROUP BY 1)", select="SELECT type, n, round(100.0 * n / sum(n) OVER (), 6) AS pct FROM k"))
def _(spark, sf):
    rows = tokens(spark, sf).filter("q <> m").withColumn("type", P.majority_class(F.col("q"), F.col("m"), F.col("c")))
    return spans.counts_with_share(rows, "type").withColumn("pct", F.round("pct", 6))


# a phrase pair per line: the line against its folded form without its last words, so all categories occur
def _phrases(spark, sf):
    from variorum.plans.corpus import lines

    h = (F.col("doc_id") + F.col("line_no")) % 11
    w = T.tokens_ws(F.col("line"))
    head = lambda n: F.array_join(F.slice(w, 1, n), " ")
    q = F.when(h == 0, "").when(h == 1, "...").when(h < 6, head(1)).otherwise(head(6))
    m = (
        F.when(h == 0, head(3)).when(h == 1, head(1)).when(h == 2, F.concat(head(1), F.lit("xy"))).when(h == 3, F.concat(head(1), F.lit("!"))).when(h == 4, F.reverse(head(1)))
        .when(h == 5, F.lit("?!")).when(h == 6, F.concat(head(6), F.lit("."))).when(h == 7, T.strip_accents(head(6))).when(h == 8, F.concat(head(5), F.lit(" zz"))).when(h == 9, head(4)).otherwise(head(1))
    )
    rows = lines(spark, sf).filter(F.size(w) > 0)
    return rows.select("doc_id", "line_no", q.alias("q"), m.alias("m"))


def _ascii(x: str) -> str:
    return f"regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')"


_SQL_PHR = (SQL_LINES, """
w AS (SELECT doc_id, line_no, (doc_id + line_no) % 11 AS h, list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '') AS w FROM lines),
g AS (SELECT doc_id, line_no, h, w[1] AS h1, array_to_string(w[1:3], ' ') AS h3, array_to_string(w[1:4], ' ') AS h4, array_to_string(w[1:5], ' ') AS h5, array_to_string(w[1:6], ' ') AS h6 FROM w WHERE len(w) > 0),""".strip() + f"""
ph AS (SELECT doc_id, line_no, CASE WHEN h = 0 THEN '' WHEN h = 1 THEN '...' WHEN h < 6 THEN h1 ELSE h6 END AS q,
  CASE h WHEN 0 THEN h3 WHEN 1 THEN h1 WHEN 2 THEN h1 || 'xy' WHEN 3 THEN h1 || '!' WHEN 4 THEN reverse(h1) WHEN 5 THEN '?!' WHEN 6 THEN h6 || '.' WHEN 7 THEN {_ascii('h6')} WHEN 8 THEN h5 || ' zz' WHEN 9 THEN h4 ELSE h1 END AS m FROM g)""")


def _category(mode: str) -> str:
    sq, sm = _strip("q"), _strip("m")
    a, b = fold(sq), fold(sm)
    word = f"""WHEN nq = 1 AND nm = 1 THEN CASE WHEN ld = 0 THEN 'punctuation only' WHEN ld <= 2 THEN 'spelling variant (1–2 edits)' WHEN {a} = {b} THEN 'accent/diacritic' ELSE 'different word (single)' END"""
    punct = f"WHEN {sq} = '' THEN 'insertion (M phrase)' WHEN {sm} = '' THEN 'deletion (Q phrase)'"
    first, second = (word, punct) if mode == "report" else (punct, word)
    return f"""CASE WHEN nq = 0 THEN 'insertion (M only)' WHEN nm = 0 THEN 'deletion (Q only)' {first} {second}
      WHEN lower({sq}) = lower({sm}) THEN 'punctuation only' WHEN {fold('q')} = {fold('m')} THEN 'accent/diacritic'
      WHEN nq = nm AND diffs = 1 THEN 'phrase, one word differs' WHEN nq = nm THEN 'phrase, multiple words differ'
      WHEN abs(nq - nm) <= 2 THEN 'phrase, minor length diff' ELSE 'phrase, major divergence' END"""


# edit distance counts characters; the oracle's counts bytes, so both get text mapped to one byte per character
_SQL_CAT = (*_SQL_PHR, f"""
pw AS (SELECT *, list_filter(regexp_split_to_array(q, '\\s+'), lambda x: x <> '') AS qw, list_filter(regexp_split_to_array(m, '\\s+'), lambda x: x <> '') AS mw FROM ph),
pc AS (SELECT doc_id, line_no, q, m, len(qw) AS nq, len(mw) AS nm,
  levenshtein(translate(lower({_strip('q')}), 'éèêçóñüäößíàâîôûùúá', '0123456789@#$%&*+=~'), translate(lower({_strip('m')}), 'éèêçóñüäößíàâîôûùúá', '0123456789@#$%&*+=~')) AS ld,
  len(list_filter(range(1, least(len(qw), len(mw)) + 1), lambda i: {fold('qw[i]')} <> {fold('mw[i]')})) AS diffs FROM pw)""")


@query("difference_category", "P27 N14", sql(*_SQL_CAT, select=f"SELECT doc_id, line_no, q, m, {_category('report')} AS report, {_category('mark')} AS mark FROM pc"))
def _(spark, sf):
    q, m = F.col("q"), F.col("m")
    return _phrases(spark, sf).select("doc_id", "line_no", "q", "m", P.difference_category(q, m).alias("report"), P.difference_category(q, m, "mark").alias("mark"))


@query("category_pct", "G5 P28 O3 W19", sql(*_SQL_CAT, f"k AS (SELECT {_category('mark')} AS category, count(*) AS n FROM pc GROUP BY 1)", select="""
SELECT category, n, round(100.0 * n / sum(n) OVER (), 6) AS pct, category IN ('phrase, major divergence', 'different word (single)', 'phrase, multiple words differ') AS high,
  CAST(list_position(['phrase, major divergence', 'different word (single)', 'phrase, multiple words differ', 'phrase, one word differs', 'insertion (M only)', 'insertion (M phrase)', 'deletion (Q only)',
    'deletion (Q phrase)', 'phrase, minor length diff', 'spelling variant (1–2 edits)', 'accent/diacritic', 'punctuation only'], category) - 1 AS BIGINT) AS severity FROM k"""))
def _(spark, sf):
    rows = _phrases(spark, sf).withColumn("category", P.difference_category(F.col("q"), F.col("m"), "mark"))
    counts = spans.counts_with_share(rows, "category").withColumn("pct", F.round("pct", 6))
    return counts.withColumn("high", P.is_high_severity(F.col("category"))).withColumn("severity", spans.severity_rank(F.col("category")))


# neighbouring token windows of the same line play the two contexts
def _drifts(spark, sf):
    from variorum.plans.corpus import lines

    w = T.tokens_ws(F.col("line"))
    rows = lines(spark, sf).withColumn("w", w).filter(F.size("w") >= 6)
    part = lambda lo, n: F.array_join(F.slice("w", lo, n), " ")
    rows = rows.select("doc_id", "line_no", part(1, 2).alias("q"), part(3, 2).alias("m"), part(2, 12).alias("q_ctx"), part(5, 12).alias("m_ctx"))
    d = spans.drift(F.col("q"), F.col("m"), F.col("q_ctx"), F.col("m_ctx"))
    return rows.withColumn("d", d).select("doc_id", "line_no", "q", "m", F.col("d.likely").alias("likely"), F.col("d.words").alias("words"), F.col("d.label").alias("label"))


def _sig(x: str) -> str:
    return f"list_distinct(list_transform(list_filter(list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> ''), lambda w: length({_strip('w')}) >= 3), lambda w: {fold(_strip('w'))}))"


_SQL_DRIFT = (SQL_LINES, f"""
w AS (SELECT doc_id, line_no, list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '') AS w FROM lines),
p AS (SELECT doc_id, line_no, array_to_string(w[1:2], ' ') AS q, array_to_string(w[3:4], ' ') AS m, array_to_string(w[2:13], ' ') AS qc, array_to_string(w[5:16], ' ') AS mc FROM w WHERE len(w) >= 6),
s AS (SELECT *, {_sig('q')} AS qs, {_sig('m')} AS ms, {_sig('qc')} AS qcs, {_sig('mc')} AS mcs FROM p),
x AS (SELECT *, list_sort(list_intersect(qs, mcs)) AS qim, list_sort(list_intersect(ms, qcs)) AS miq FROM s),
dr AS (SELECT doc_id, line_no, q, m, CASE WHEN len(qs) = 0 OR len(ms) = 0 THEN NULL WHEN len(qim) > 0 AND len(miq) = 0 THEN 'Q' WHEN len(miq) > 0 AND len(qim) = 0 THEN 'M' WHEN len(qim) > 0 AND len(miq) > 0 THEN 'ambiguous' END AS likely,
  qim, miq FROM x)""")


@query("drift_detect", "W20 U4 T5", sql(*_SQL_DRIFT, select="""
SELECT doc_id, line_no, likely, array_to_string(CASE likely WHEN 'Q' THEN qim WHEN 'M' THEN miq WHEN 'ambiguous' THEN list_sort(list_distinct(list_concat(qim, miq))) END, ',') AS words,
  CASE likely WHEN 'Q' THEN q WHEN 'M' THEN m ELSE '' END AS suggestion FROM dr"""))
def _(spark, sf):
    rows = _drifts(spark, sf)
    words = F.when(F.col("words").isNotNull(), F.array_join("words", ","))
    return rows.select("doc_id", "line_no", "likely", words.alias("words"), spans.suggestion(F.col("likely"), F.col("q"), F.col("m")).alias("suggestion"))


@query("drift_counts", "G6", sql(*_SQL_DRIFT, select="""
SELECT count(likely) AS drift, count(*) FILTER (likely = 'Q') AS drift_q, count(*) FILTER (likely = 'M') AS drift_m, count(*) FILTER (likely = 'ambiguous') AS ambiguous, count(*) - count(likely) AS none FROM dr"""))
def _(spark, sf):
    likely = F.col("likely")
    return _drifts(spark, sf).agg(
        F.count("likely").alias("drift"), F.count_if(likely == "Q").alias("drift_q"), F.count_if(likely == "M").alias("drift_m"),
        F.count_if(likely == "ambiguous").alias("ambiguous"), (F.count("*") - F.count("likely")).alias("none"),
    )


@query("fourth_verdicts", "P29 R7", sql(*_SQL_TOK, f"""
o AS (SELECT *, CASE WHEN (doc_id + line_no + pos) % 2 = 0 THEN q WHEN (doc_id + line_no + pos) % 3 = 0 THEN m WHEN (doc_id + line_no + pos) % 5 = 0 THEN c WHEN (doc_id + line_no + pos) % 7 = 0 THEN '' ELSE 'none' END AS o
  FROM t WHERE {_MAJ} = 'Q≠M≠C' AND q <> m)""", select=f"""
SELECT doc_id, line_no, pos, CASE WHEN o = '' THEN 'skip_na' WHEN {fold('o')} = {fold('q')} AND {fold('o')} <> {fold('m')} THEN 'apply' WHEN {fold('o')} = {fold('m')} AND {fold('o')} <> {fold('q')} THEN 'keep_m'
  WHEN {fold('o')} = {fold('c')} THEN 'keep_c' ELSE 'skip_none' END AS verdict FROM o"""))
def _(spark, sf):
    rows = tokens(spark, sf).filter("q <> m").withColumn("type", P.majority_class(F.col("q"), F.col("m"), F.col("c")))
    h = F.col("doc_id") + F.col("line_no") + F.col("pos")
    o = F.when(h % 2 == 0, F.col("q")).when(h % 3 == 0, F.col("m")).when(h % 5 == 0, F.col("c")).when(h % 7 == 0, "").otherwise("none")
    return spans.unresolved(rows).select("doc_id", "line_no", "pos", P.fourth_verdict(F.col("q"), F.col("m"), F.col("c"), o).alias("verdict"))


@query("span_numbering", "W18 W19 N28 N29", sql(*_SQL_TOK, f"""
s AS (SELECT doc_id, line_no, pos, q, m, {_MAJ} AS category FROM t WHERE q <> m),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY category, line_no, pos) AS rn, lag(category) OVER (PARTITION BY doc_id ORDER BY category, line_no, pos) AS before FROM s)""", select="""
SELECT doc_id || '_s' || line_no || '_' || rn AS span_id, CAST(rn AS INTEGER) AS ordinal, coalesce(before <> category, true) AS opens_section,
  '{"q":' || to_json(q) || ',"m":' || to_json(m) || '}' AS meta FROM n"""))
def _(spark, sf):
    rows = tokens(spark, sf).filter("q <> m").withColumn("category", P.majority_class(F.col("q"), F.col("m"), F.col("c"))).withColumnRenamed("line_no", "unit_no")
    order = ["category", "unit_no", "pos"]
    rows = review.section_headers(review.numbered(rows, BOOK, order), BOOK, order)
    return rows.select("span_id", "ordinal", "opens_section", review.meta(["q", "m"]).alias("meta"))
