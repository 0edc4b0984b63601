"""Folding, tokenising and describing text."""

from __future__ import annotations

from pyspark.sql import functions as F

from variorum.functions import predicates as P
from variorum.functions import text as T
from variorum.plans.corpus import PARAMS, SQL_LINES, documents, fold, lines, sql, table
from variorum.plans.registry import query

_STRIP = "trim(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'))"
_WORDS = "list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"
_NOISE_W = P.noise_pattern("witness", PARAMS).replace("'", "''")


def _strip(x: str) -> str:
    return _STRIP.format(x=x)


def _words(x: str) -> str:
    return _WORDS.format(x=x)


def _ascii_words(line: str) -> str:
    t = f"regexp_replace(trim({line}), '\\[[^\\]]{{0,120}}\\]', ' ', 'g')"
    t = f"regexp_replace(regexp_replace({t}, '^#+\\s*', ''), '[—–]', ' ', 'g')"
    t = f"lower(regexp_replace(strip_accents({t}), '[^\\x00-\\x7F]', '', 'g'))"
    return f"regexp_extract_all({t}, '\\b[a-z'']+\\b')"


@query("norm_fold", "N1 D2", f"SELECT doc_id, {fold('text')} AS folded FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", T.fold(F.col("text")).alias("folded"))


@query("fold_tokens", "N35 N36", f"""
WITH t AS (SELECT conv_id, turn, {_words('text')} AS w FROM conversations)
SELECT conv_id, turn, array_to_string(list_transform(w, lambda x: {fold('x')}), ' ') AS folded, CAST(len(w) AS INTEGER) AS n FROM t""")
def _(spark, sf):
    w = T.reading_words(F.col("text"), titles=PARAMS.running_titles)
    rows = table(spark, sf, "conversations").select("conv_id", "turn", w.alias("w"))
    return rows.select("conv_id", "turn", F.array_join(T.fold_tokens(F.col("w")), " ").alias("folded"), F.size("w").alias("n"))


@query("strong_fold", "N2", f"""
WITH t AS (SELECT unnest({_words('text')}) AS token FROM documents)
SELECT token, regexp_replace(replace(regexp_replace(strip_accents(lower(token)), '[^\\x00-\\x7F]', '', 'g'), '''', ''),
  '^[[:punct:]]+|[[:punct:]]+$', '', 'g') AS folded, count(*) AS n FROM t GROUP BY token""")
def _(spark, sf):
    tokens = documents(spark, sf).select(F.explode(T.tokens_ws(F.col("text"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return tokens.select("token", T.fold_strong(F.col("token")).alias("folded"), "n")


@query("accent_strip", "N3", "SELECT doc_id, regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g') AS plain FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", T.strip_accents(F.col("text")).alias("plain"))


@query("ascii_fold_map", "N4", "SELECT doc_id, translate(text, 'ÓóÁáÚúÉéÍí', 'OoAaUuEeIi') AS mapped FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", T.ascii_fold_map(F.col("text")).alias("mapped"))


@query("punct_strip", "N5", sql(SQL_LINES, select=f"SELECT doc_id, line_no, {_strip('line')} AS stripped FROM lines"))
def _(spark, sf):
    return lines(spark, sf).select("doc_id", "line_no", T.strip_punct(F.col("line")).alias("stripped"))


@query("words_no_punct", "N6", sql(SQL_LINES, select=f"""
SELECT doc_id, line_no, array_to_string(list_transform({_words("regexp_replace(line, '[^\\p{L}\\p{N}_\\s]', '', 'g')")},
  lambda w: {fold('w')}), ' ') AS words FROM lines"""))
def _(spark, sf):
    return lines(spark, sf).select("doc_id", "line_no", F.array_join(T.words_no_punct(F.col("line")), " ").alias("words"))


# the text has no typographic marks, so sentence ends and ampersands are dressed up first
_FMT_SQL = "replace(replace(replace(replace(text, '. ', '… '), ', ', ' — '), '&', '“'), '$', '’')"


@query("format_normalize", "N7", f"""
WITH f AS (SELECT doc_id, {_FMT_SQL} AS t FROM documents)
SELECT doc_id, regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(t, '[''‘’ʼ`´]', '''', 'g'), '["“”„«»]', '"', 'g'),
  '…', '...'), '\\.\\s*\\.\\s*\\.', '...', 'g'), '[–—‒―]', '--', 'g') AS normal FROM f""")
def _(spark, sf):
    t = F.col("text")
    for old, new in ((". ", "… "), (", ", " — "), ("&", "“"), ("$", "’")):
        t = F.replace(t, F.lit(old), F.lit(new))
    return documents(spark, sf).select("doc_id", T.normalize_format(t).alias("normal"))


# words of six letters and more are split after the third where the line and word numbers say so
def _split_sql(line: str) -> str:
    return (f"array_to_string(list_transform(string_split({line}, ' '), lambda t, i: CASE WHEN (doc_id + line_no + i - 1) % 7 = 3 "
            "AND regexp_matches(t, '^\\p{L}{6,}$') THEN t[1:3] || '- ' || t[4:] ELSE t END), ' ')")


def _split_lines(spark, sf):
    broken = F.array_join(
        F.transform(
            F.split("line", " "),
            lambda t, i: F.when(
                ((F.col("doc_id") + F.col("line_no") + i) % 7 == 3) & t.rlike(r"^\p{L}{6,}$"),
                F.concat(F.left(t, F.lit(3)), F.lit("- "), t.substr(F.lit(4), F.length(t))),
            ).otherwise(t),
        ),
        " ",
    )
    return lines(spark, sf).withColumn("broken", broken)


_BREAK = "'([\\p{L}\\p{N}_]+)-\\s+([\\p{L}\\p{N}_]+)'"


@query("linebreak_collapse", "N8 N10 P37", sql(SQL_LINES, f"s AS (SELECT *, {_split_sql('line')} AS broken FROM lines)", select=f"""
SELECT doc_id, line_no, regexp_replace(broken, {_BREAK}, '\\1\\2', 'g') AS joined,
  regexp_replace(broken, '([a-záéíóúüñ])- ([a-záéíóúüñ])', '\\1\\2', 'g') AS repaired,
  regexp_matches(broken, {_BREAK}) AS has_break FROM s"""))
def _(spark, sf):
    b = F.col("broken")
    return _split_lines(spark, sf).select("doc_id", "line_no", T.collapse_linebreaks(b).alias("joined"), T.repair_intraline(b).alias("repaired"), P.has_linebreak(b).alias("has_break"))


@query("split_words", "N9", sql(SQL_LINES, f"s AS (SELECT *, {_split_sql('line')} AS broken FROM lines)", f"""
p AS (SELECT doc_id, line_no, line, unnest(regexp_extract_all(broken, {_BREAK}, 0)) AS split, unnest(regexp_extract_all(broken, {_BREAK}, 1)) AS a,
  unnest(regexp_extract_all(broken, {_BREAK}, 2)) AS b FROM s)""", select=f"""
SELECT DISTINCT doc_id, line_no, split, a || b AS joined FROM p
WHERE list_contains(list_transform({_words('line')}, lambda w: {fold('w')}), {fold('a || b')})"""))
def _(spark, sf):
    rows = _split_lines(spark, sf).select("doc_id", "line_no", F.explode(T.split_words(F.col("broken"), F.col("line"))).alias("w"))
    return rows.select("doc_id", "line_no", "w.split", "w.joined")


@query("linebreak_only_spans", "P25", sql(SQL_LINES, f"s AS (SELECT *, {_split_sql('line')} AS broken, replace(line, ',', '') AS other FROM lines)", select=f"""
SELECT doc_id, line_no, (regexp_matches(broken, {_BREAK}) OR regexp_matches(other, {_BREAK}))
  AND list_transform({_words(f"regexp_replace(regexp_replace(broken, {_BREAK}, '\\1\\2', 'g'), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')")}, lambda w: {fold('w')})
    = list_transform({_words("regexp_replace(other, '[^\\p{L}\\p{N}_\\s]', '', 'g')")}, lambda w: {fold('w')}) AS linebreak_only FROM s"""))
def _(spark, sf):
    other = F.replace("line", F.lit(","), F.lit(""))
    return _split_lines(spark, sf).select("doc_id", "line_no", P.is_linebreak_only(F.col("broken"), other).alias("linebreak_only"))


@query("formatting_only_spans", "P26", sql(SQL_LINES, """
v AS (SELECT doc_id, line_no, CASE WHEN line_no % 2 = 0 THEN replace(line, '.', '…') ELSE replace(line, ',', '—') END AS q,
  CASE WHEN line_no % 3 = 0 THEN replace(line, '.', '...') ELSE replace(line, ',', '--') END AS m FROM lines)""", select="""
SELECT doc_id, line_no, q <> m AND regexp_replace(regexp_replace(replace(q, '…', '...'), '\\.\\s*\\.\\s*\\.', '...', 'g'), '[–—‒―]', '--', 'g')
  = regexp_replace(regexp_replace(replace(m, '…', '...'), '\\.\\s*\\.\\s*\\.', '...', 'g'), '[–—‒―]', '--', 'g') AS format_only FROM v"""))
def _(spark, sf):
    line, n = F.col("line"), F.col("line_no")
    q = F.when(n % 2 == 0, F.replace(line, F.lit("."), F.lit("…"))).otherwise(F.replace(line, F.lit(","), F.lit("—")))
    m = F.when(n % 3 == 0, F.replace(line, F.lit("."), F.lit("..."))).otherwise(F.replace(line, F.lit(","), F.lit("--")))
    return lines(spark, sf).select("doc_id", "line_no", P.is_format_only(q, m).alias("format_only"))


@query("tokenize_word", "N11", """
SELECT token, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS token FROM documents) GROUP BY token""")
def _(spark, sf):
    rows = documents(spark, sf).select("doc_id", F.explode(T.tokens_word(F.col("text"))).alias("token"))
    per_doc = rows.groupBy("token", "doc_id").agg(F.count("*").alias("k"))
    return per_doc.groupBy("token").agg(F.sum("k").alias("n"), F.count("*").alias("n_docs"))


@query("tokenize_ascii", "N11 P5", f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no FROM documents),
t AS (SELECT doc_id, no, {_ascii_words('line')} AS w FROM l WHERE trim(line) <> '' AND NOT regexp_matches(trim(line), '{_NOISE_W}'))
SELECT d.doc_id, coalesce(string_agg(array_to_string(w, ' '), ' ' ORDER BY no) FILTER (len(w) > 0), '') AS words
FROM documents d LEFT JOIN t USING (doc_id) GROUP BY d.doc_id""")
def _(spark, sf):
    words = T.tokens_ascii(F.col("text"), P.noise_pattern("witness", PARAMS))
    return documents(spark, sf).select("doc_id", F.array_join(words, " ").alias("words"))


@query("tokenize_ws", "N11 D10", f"""
WITH t AS (SELECT doc_id, {_words('text')} AS w FROM documents)
SELECT doc_id, CAST(unnest(range(len(w))) AS INTEGER) AS pos, unnest(w) AS token FROM t""")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", F.posexplode(T.tokens_ws(F.col("text"))).alias("pos", "token"))


@query("tokenize_latin", "N11", "SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[a-zA-ZÀ-ÿ''’-]+'), ' ') AS words FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", F.array_join(T.tokens_latin(F.col("text")), " ").alias("words"))


@query("token_counts_by_source", "G12", f"""
SELECT source, CAST(sum(len({_words('text')})) AS BIGINT) AS n_words, count(*) AS n_units FROM documents GROUP BY source""")
def _(spark, sf):
    rows = documents(spark, sf)
    return rows.groupBy("source").agg(F.sum(F.size(T.tokens_ws(F.col("text")))).alias("n_words"), F.count("*").alias("n_units"))


@query("refusal_filter", "P1", """
SELECT 'documents' AS kind, count(*) AS n, count(*) FILTER (regexp_matches(lower(text), 'cannot transcribe|copyrighted|i can summarize|i cannot reproduce|copyright infringement')) AS n_refused FROM documents
UNION ALL SELECT role, count(*), count(*) FILTER (regexp_matches(lower(text), 'cannot transcribe|copyrighted|i can summarize|i cannot reproduce|copyright infringement')) FROM conversations GROUP BY role""")
def _(spark, sf):
    both = documents(spark, sf).select(F.lit("documents").alias("kind"), "text").unionByName(table(spark, sf, "conversations").select(F.col("role").alias("kind"), "text"))
    return both.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(P.is_refusal(F.col("text"))).alias("n_refused"))


_DIRTY = "CASE WHEN (doc_id + line_no) % 9 = 0 THEN 'Collected witnesses' WHEN (doc_id + line_no) % 9 = 1 THEN '[Page shows a map] ' || line WHEN (doc_id + line_no) % 9 = 2 THEN '═══' WHEN (doc_id + line_no) % 9 = 3 THEN '[Page 4] ' || line WHEN (doc_id + line_no) % 9 = 4 THEN '[A_ERROR: timeout]' ELSE line END"


@query("noise_lines", "P5", sql(SQL_LINES, f"d AS (SELECT doc_id, line_no, {_DIRTY} AS line FROM lines)", select="""
SELECT doc_id, line_no,
  regexp_matches(line, '(?i)^(?:━+|═+|#\\s|Source:\\s|COLLECTED WITNESSES\\s*$|EDITED BY|\\[Page shows|\\[Page is blank|\\[Page -|\\[Left page|\\[Right page|\\[EXTRACTION FAILED|\\[NEEDS_REVIEW|I appreciate your detailed)') AS first,
  regexp_matches(line, '(?i)^(?:\\[Page\\s+\\d+|={3,}|\\[Assembly note|COLLECTED WITNESSES\\s*$|EDITED BY)') AS second,
  regexp_matches(line, '(?i)^(?:#\\s|<<< SPREAD|={3,}|COLLECTED WITNESSES\\s*$|EDITED BY|\\[Page shows|\\[Page is blank|\\[Page -|\\[Left page|\\[Right page|\\[EXTRACTION FAILED|\\[NEEDS_REVIEW|\\[[A-Z]+_ERROR|\\[Assembly note)') AS witness
FROM d"""))
def _(spark, sf):
    h = (F.col("doc_id") + F.col("line_no")) % 9
    dirty = (
        F.when(h == 0, "Collected witnesses").when(h == 1, F.concat(F.lit("[Page shows a map] "), "line")).when(h == 2, "═══")
        .when(h == 3, F.concat(F.lit("[Page 4] "), "line")).when(h == 4, "[A_ERROR: timeout]").otherwise(F.col("line"))
    )
    rows = lines(spark, sf).select("doc_id", "line_no", dirty.alias("line"))
    return rows.select("doc_id", "line_no", *[F.col("line").rlike(P.noise_pattern(k, PARAMS)).alias(k) for k in ("first", "second", "witness")])


@query("edit_distance_pairs", "N14", f"""
SELECT a.conv_id, a.turn, CAST(levenshtein({fold('a.text')}, {fold('b.text')}) AS INTEGER) AS distance
FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def _(spark, sf):
    return _turn_pairs(spark, sf).select("conv_id", "turn", T.edit_distance(T.fold(F.col("a")), T.fold(F.col("b"))).alias("distance"))


def _turn_pairs(spark, sf):
    rows = table(spark, sf, "conversations")
    a = rows.select("conv_id", "turn", F.col("text").alias("a"))
    b = rows.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("b"))
    return a.join(b, ["conv_id", "turn"], "inner")


@query("token_overlap_pairs", "N15 N16 T5", """
WITH t AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(text), '[a-zA-ZÀ-ÿ''’-]+')) AS s FROM conversations),
p AS (SELECT a.conv_id, a.turn, len(a.s) AS na, len(b.s) AS nb, len(list_intersect(a.s, b.s)) AS k
  FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, CASE WHEN na = 0 OR nb = 0 THEN 0.0 ELSE round(k / greatest(na, nb), 6) END AS similarity,
  CASE WHEN na > 0 THEN round(k / na, 6) ELSE 0.0 END AS recall, CASE WHEN nb > 0 THEN round(k / nb, 6) ELSE 0.0 END AS prec FROM p""")
def _(spark, sf):
    a, b = (F.array_distinct(T.tokens_latin(F.col(c))) for c in ("a", "b"))
    rows = _turn_pairs(spark, sf).select("conv_id", "turn", a.alias("a"), b.alias("b"))
    rp = T.recall_precision(F.col("a"), F.col("b"))
    return rows.select("conv_id", "turn", F.round(T.overlap_similarity(F.col("a"), F.col("b")), 6).alias("similarity"), F.round(rp["recall"], 6).alias("recall"), F.round(rp["precision"], 6).alias("prec"))


@query("significant_words", "N17", f"""
WITH t AS (SELECT doc_id, unnest({_words('text')}) AS w FROM documents)
SELECT doc_id, count(DISTINCT {fold(_strip('w'))}) AS n_words, min({fold(_strip('w'))}) AS first_word FROM t WHERE length({_strip('w')}) >= 3 GROUP BY doc_id""")
def _(spark, sf):
    rows = documents(spark, sf).select("doc_id", T.sig_words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    return rows.select("doc_id", F.size("w").cast("bigint").alias("n_words"), F.array_min("w").alias("first_word"))


@query("excerpts", "N20 N19", sql(SQL_LINES, """
h AS (SELECT doc_id, line_no, line, instr(line, ', ') - 1 AS s FROM lines WHERE line LIKE '%, %'),
c AS (SELECT *, greatest(0, s - 40) AS lo, least(length(line), s + 2 + 40) AS hi FROM h)""", select="""
SELECT doc_id, line_no, CASE WHEN lo > 0 THEN '…' ELSE '' END || trim(substring(line, lo + 1, hi - lo)) || CASE WHEN hi < length(line) THEN '…' ELSE '' END AS excerpt,
  CAST(round_even(100 * s / length(line), 0) AS INTEGER) AS pct FROM c"""))
def _(spark, sf):
    rows = lines(spark, sf).filter(F.col("line").contains(", ")).withColumn("s", F.instr("line", ", ") - 1)
    return rows.select("doc_id", "line_no", T.excerpt(F.col("line"), F.col("s"), F.col("s") + 2).alias("excerpt"), T.position_pct(F.col("s"), F.length("line")).alias("pct"))


@query("excerpts_all", "N20 N19 P33", sql(SQL_LINES, """
w AS (SELECT doc_id, line_no, line, string_split(line, ', ') AS parts FROM lines WHERE contains(line, ', ')),
h AS (SELECT doc_id, line_no, line, k, list_sum(list_transform(parts[1:k], lambda x: length(x)))::INTEGER + 2 * (k - 1) AS s FROM (SELECT *, unnest(range(1, len(parts)))::INTEGER AS k FROM w)),
c AS (SELECT *, greatest(0, s - 40) AS lo, least(length(line), s + 2 + 40) AS hi FROM h)""", select="""
SELECT doc_id, line_no, k AS hit_no, s::INTEGER AS at, CASE WHEN lo > 0 THEN '…' ELSE '' END || trim(substring(line, lo + 1, hi - lo)) || CASE WHEN hi < length(line) THEN '…' ELSE '' END AS excerpt,
  CAST(round_even(100 * s / length(line), 0) AS INTEGER) AS pct FROM c"""))
def _(spark, sf):
    """An excerpt around every hit of a phrase, not only a line's first."""
    rows = lines(spark, sf).filter(F.col("line").contains(", "))
    rows = rows.select("doc_id", "line_no", "line", F.posexplode(T.positions(F.col("line"), ", ")).alias("k", "s"))
    excerpt, pct = T.excerpt(F.col("line"), F.col("s"), F.col("s") + 2), T.position_pct(F.col("s"), F.length("line"))
    return rows.select("doc_id", "line_no", (F.col("k") + 1).alias("hit_no"), F.col("s").alias("at"), excerpt.alias("excerpt"), pct.alias("pct"))


@query("context_window", "N21", f"""
WITH t AS (SELECT doc_id, {_words('text')} AS w FROM documents), p AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM t)
SELECT doc_id, CAST(i AS INTEGER) AS pos, array_to_string(w[greatest(1, i - 6):i], ' ') AS left_ctx, array_to_string(w[i + 2:i + 8], ' ') AS right_ctx
FROM p WHERE w[i + 1] LIKE '%,'""")
def _(spark, sf):
    rows = documents(spark, sf).select("doc_id", T.tokens_ws(F.col("text")).alias("w"))
    w = F.col("w")
    # contexts are cut inside the row, so the token array is not copied per hit
    cut = F.transform(w, lambda t, i: F.when(t.endswith(","), F.struct(i.alias("pos"), T.left_context(w, i, 7).alias("left_ctx"), T.right_context(w, i + 1, 7).alias("right_ctx"))))
    return rows.select("doc_id", F.explode(F.filter(cut, lambda x: x.isNotNull())).alias("c")).select("doc_id", "c.*")


@query("wide_context", "N22", f"""
WITH t AS (SELECT b.item_id, {_words('b.text')} AS w, {_words('b.text')}[-3:] AS target FROM benchmark b),
f AS (SELECT item_id, w, list_transform(w, lambda x: {fold(_strip('x'))}) AS g,
  list_transform(list_filter(target, lambda x: length({_strip('x')}) >= 3), lambda x: {fold(_strip('x'))}) AS wanted FROM t),
a AS (SELECT item_id, w, len(w) AS n, coalesce(list_min(list_filter(list_transform(range(len(w)), lambda i: CASE WHEN list_contains(wanted, g[i + 1]) THEN i END), lambda i: i IS NOT NULL)), len(w) // 2) AS anchor FROM f)
SELECT item_id, array_to_string(w[greatest(0, anchor - 10) + 1:anchor], ' ') AS before, array_to_string(w[anchor + 1:least(n, anchor + 10)], ' ') AS after FROM a""")
def _(spark, sf):
    rows = table(spark, sf, "benchmark").select("item_id", T.tokens_ws(F.col("text")).alias("w"))
    target = F.array_join(F.slice("w", F.greatest(F.size("w") - 2, F.lit(1)), 3), " ")
    rows = rows.withColumn("x", T.wide_context(F.col("w"), target, 20))
    return rows.select("item_id", "x.before", "x.after")


@query("html_escape", "N23 S25", """
SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS body,
  replace(replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS attr,
  '<tr><th>' || page_id || '</th><td>' || replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</td></tr>' AS card FROM pages""")
def _(spark, sf):
    from variorum.sources.structured import report_card

    return table(spark, sf, "pages").select("page_id", T.html_escape(F.col("html")).alias("body"), T.html_escape(F.col("url"), True).alias("attr"), report_card(F.col("page_id"), [F.col("url")]).alias("card"))


@query("display_clean", "N25 N26 P32", sql(SQL_LINES, """
d AS (SELECT doc_id, line_no, CASE (doc_id + line_no) % 6 WHEN 0 THEN '[Page ' || line_no || '] COLLECTED WITNESSES ' || line WHEN 1 THEN 'THE CLOSING WORDS ' || line
  WHEN 2 THEN '[ ... ]  ' || line WHEN 3 THEN '[decorative break]' WHEN 4 THEN '[Page 3] ' ELSE line END AS line FROM lines),
c AS (SELECT doc_id, line_no, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(line,
  '(?i)\\[Page(?:\\s+LEFT|\\s+RIGHT)?\\s*\\d*\\]\\s*(?:COLLECTED\\s+WITNESSES|OPENING|MÍDDLE\\s+PASSAGE|THE\\s+CLOSING\\s+WORDS)?\\s*', '', 'g'),
  '(?:COLLECTED\\s+WITNESSES|OPENING|MÍDDLE\\s+PASSAGE|THE\\s+CLOSING\\s+WORDS)', '', 'g'), '\\[\\s*\\.{2,}\\s*\\]|\\[\\s*…\\s*\\]', '[illegible]', 'g'), '  +', ' ', 'g')) AS text FROM d)""", select="""
SELECT doc_id, line_no, CASE WHEN text = '[decorative break]' THEN NULL ELSE text END AS text, CASE WHEN text = '[decorative break]' THEN 'section_break' ELSE 'paragraph' END AS type,
  'chap-' || translate(replace(lower(text), ' ', '-'), 'óáéíú', 'oaeiu') AS anchor FROM c WHERE text <> ''"""))
def _(spark, sf):
    from variorum.operators.assemble import display_blocks

    h, line = (F.col("doc_id") + F.col("line_no")) % 6, F.col("line")
    text = (
        F.when(h == 0, F.concat(F.lit("[Page "), F.col("line_no").cast("string"), F.lit("] COLLECTED WITNESSES "), line)).when(h == 1, F.concat(F.lit("THE CLOSING WORDS "), line))
        .when(h == 2, F.concat(F.lit("[ ... ]  "), line)).when(h == 3, "[decorative break]").when(h == 4, "[Page 3] ").otherwise(line)
    )
    rows = display_blocks(lines(spark, sf).select("doc_id", "line_no", F.lit("paragraph").alias("type"), text.alias("text")), PARAMS)
    return rows.select("doc_id", "line_no", "text", "type", T.anchor_slug(F.coalesce("text", F.lit("[decorative break]"))).alias("anchor"))


@query("highlight_drift", "N30", f"""
WITH p AS (SELECT a.conv_id, a.turn, {_words('a.text')} AS w,
  list_distinct(list_transform(list_filter({_words('b.text')}, lambda x: length({_strip('x')}) >= 3), lambda x: {fold(_strip('x'))})) AS s
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, array_to_string(list_transform(w, lambda x: CASE WHEN list_contains(s, {fold(_strip('x'))}) THEN '*' || x || '*' ELSE x END), ' ') AS marked FROM p""")
def _(spark, sf):
    return _turn_pairs(spark, sf).select("conv_id", "turn", T.highlight(F.col("a"), T.sig_words(F.col("b"))).alias("marked"))


@query("paragraph_split", "N32 S6", """
WITH t AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(replace(replace(text, '.' || chr(10), '.' || chr(10) || ' ' || chr(10)), '!' || chr(10), chr(10) || '#Small ornament break#' || chr(10)), '\\n\\s*\\n'),
  lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS p FROM documents)
SELECT doc_id, CAST(unnest(range(len(p))) AS INTEGER) AS para_no, unnest(p) AS para FROM t""")
def _(spark, sf):
    t = F.replace("text", F.lit(".\n"), F.lit(".\n \n"))
    t = F.replace(t, F.lit("!\n"), F.lit("\n#Small ornament break#\n"))
    return documents(spark, sf).select("doc_id", F.posexplode(T.paragraphs(t)).alias("para_no", "para"))


@query("transcript_blocks", "S6", """
WITH t AS (SELECT doc_id, string_split(regexp_replace(replace(text, '!' || chr(10), chr(10) || '#Big ornament break (flower)#' || chr(10)), '\\.\\n', '.' || chr(10) || chr(10), 'g'), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(range(len(l))) AS no, trim(unnest(l)) AS line FROM t),
k AS (SELECT *, CASE WHEN lower(line) LIKE '#big ornament break%' THEN 1 ELSE 0 END AS brk FROM x),
g AS (SELECT *, sum(CASE WHEN brk = 1 OR line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY no) AS grp FROM k),
b AS (SELECT doc_id, min(no) AS start, 'paragraph' AS type, string_agg(line, ' ' ORDER BY no) AS text FROM g WHERE brk = 0 AND line <> '' GROUP BY doc_id, grp
  UNION ALL SELECT doc_id, no, 'section_break', NULL FROM g WHERE brk = 1)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS INTEGER) AS block_idx, type, text FROM b""")
def _(spark, sf):
    from variorum.operators.assemble import transcript_blocks

    t = F.replace("text", F.lit("!\n"), F.lit("\n#Big ornament break (flower)#\n"))
    t = F.replace(t, F.lit(".\n"), F.lit(".\n\n"))
    return documents(spark, sf).select("doc_id", F.posexplode(transcript_blocks(t)).alias("block_idx", "b")).select("doc_id", "block_idx", "b.type", "b.text")


@query("page_numbers", "N12 N13", """
WITH c AS (SELECT doc_id, regexp_replace(text, '\\n', chr(10) || '[Page ' || doc_id || ']' || chr(10), 'g') AS t FROM documents),
n AS (SELECT doc_id, list_transform(regexp_extract_all(t, '\\[Page\\s+(\\d+)', 1), lambda x: CAST(x AS INTEGER)) AS p FROM c)
SELECT doc_id, CAST(len(p) AS INTEGER) AS n_pages, CASE WHEN len(p) > 0 THEN 'pp. ' || list_min(p) || '–' || list_max(p) ELSE 'p. ?' END AS label FROM n""")
def _(spark, sf):
    marked = F.regexp_replace("text", F.lit("\n"), F.concat(F.lit("\n[Page "), F.col("doc_id").cast("string"), F.lit("]\n")))
    p = T.page_numbers(marked)
    return documents(spark, sf).select("doc_id", F.size(p).alias("n_pages"), T.page_label(p).alias("label"))


@query("verdict_parse", "N24 G7", """
WITH r AS (SELECT conv_id, turn, CAST(turn + 2 AS INTEGER) AS n,
  CASE turn % 3 WHEN 0 THEN '1:A 2. C 2:B 9:C' WHEN 1 THEN upper(text) ELSE 'A then B' END AS raw FROM conversations),
p AS (SELECT *, list_transform(regexp_extract_all(raw, '(\\d+)\\s*[:.\\)]\\s*([ABCU])', 1), lambda x: try_cast(x AS INTEGER)) AS k,
  regexp_extract_all(raw, '(\\d+)\\s*[:.\\)]\\s*([ABCU])', 2) AS v,
  list_filter(regexp_extract_all(raw, '[\\p{L}\\p{N}_]+'), lambda x: x IN ('A', 'B', 'C', 'U')) AS bare FROM r),
s AS (SELECT *, unnest(range(1, n + 1)) AS i FROM p)
SELECT conv_id, turn, CAST(i AS INTEGER) AS span_no, CASE WHEN len(k) > 0 THEN coalesce(v[list_max(list_filter(range(1, len(k) + 1), lambda j: k[j] = i))], 'U') ELSE coalesce(bare[i], 'U') END AS verdict FROM s""")
def _(spark, sf):
    raw = F.when(F.col("turn") % 3 == 0, "1:A 2. C 2:B 9:C").when(F.col("turn") % 3 == 1, F.upper("text")).otherwise("A then B")
    v = T.parse_verdicts(raw, (F.col("turn") + 2).cast("int"))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.posexplode(v).alias("i", "verdict"))
    return rows.select("conv_id", "turn", (F.col("i") + 1).alias("span_no"), "verdict")
