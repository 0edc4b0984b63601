"""Witnesses, pages and logs derived from the input tables, in Spark and in SQL.

A document plays a book: its lines are printed lines, five lines make a page and
two pages make a unit.  Three readings of it differ from the text at positions
given by a rule, so that every majority class occurs.  All of it is computed
inside the document's row; nothing is collected and no document is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variorum.functions import text as T
from variorum.operators.spans import spread
from variorum.params import Chapter, Params

LINES_PER_PAGE = 5
PAGES_PER_UNIT = 2

PARAMS = Params(
    bucket_pages=4,
    chapters=(Chapter("opening", "OPENING"), Chapter("middle", "MÍDDLE PASSAGE"), Chapter("closing", "THE CLOSING WORDS")),
)

# per reading: (modulus, remainder, suffix) on document number + line number + token number
EDITS = {
    "q": ((17, 3, "x"), (29, 11, "x")),
    "m": ((19, 5, "y"), (29, 11, "y")),
    "c": ((23, 7, "z"), (29, 11, "z")),
}
# inserted structural lines: (modulus, remainder, line) on document number + line number
STRUCTURE = (
    (7, 0, "LEFT PAGE:"),
    (13, 1, "[section break]"),
    (13, 2, "ornament"),
    (17, 3, "IV"),
    (19, 4, "*a note in the margin*"),
    (23, 5, "37"),
    (29, 6, "OPENING"),
    (29, 9, "MIDDLE PASSAGE"),
    (31, 7, "COLLECTED WITNESSES"),
    (37, 8, "[The left page appears blank]"),
    (41, 9, "[NEEDS_REVIEW: a.pdf spread 3 — refused]"),
    (43, 10, ""),
    (47, 11, "# THE CLOSING WORDZ"),
    (53, 12, "[...]"),
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def dealt(spark: SparkSession, sf: str) -> DataFrame:
    """Documents evened out before readings are made of them: a file may have fewer row groups than there are cores."""
    return spread(documents(spark, sf).select("doc_id", "source", "lang", "text"), ["doc_id"])


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, source, lang, line_no, line."""
    docs = documents(spark, sf)
    return docs.select("doc_id", "source", "lang", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _edit(token: Column, h: Column, reading: str) -> Column:
    out = token
    for mod, rem, suffix in reversed(EDITS[reading]):
        out = F.when(h % mod == rem, F.concat(token, F.lit(suffix))).otherwise(out)
    return F.when(token == "", token).otherwise(out)


def _edit_fourth(token: Column, h: Column) -> Column:
    side = F.when(h % 2 == 0, "x").when(h % 3 == 0, "y").otherwise("w")
    return F.when((token != "") & (h % 29 == 11), F.concat(token, side)).otherwise(token)


def _vary(token: Column, h: Column, reading: str) -> Column:
    """Edits that move words: quotes, split words, dropped and added words."""
    word = _edit_fourth(token, h) if reading == "o" else _edit(token, h, reading)
    if reading == "q":
        split = F.concat(F.left(token, F.lit(3)), F.lit("- "), token.substr(F.lit(4), F.length(token)))
        word = F.when((h % 37 == 13) & token.rlike(r"^\p{L}{6,}$"), split).otherwise(word)
        word = F.when((h % 31 == 17) & token.rlike(r"^\p{L}+$"), F.concat(F.lit('"'), token, F.lit('"'))).otherwise(word)
    elif reading in ("m", "c"):
        word = F.when((h % 31 == 17) & token.rlike(r"^\p{L}+$"), F.concat(F.lit("“"), token, F.lit("”"))).otherwise(word)
    if reading == "m":
        word = F.when(h % 41 == 0, "").when(h % 43 == 1, F.concat(F.lit("zusatz "), word)).otherwise(word)
    return word


def reading_lines(reading: str, moving: bool = False) -> Column:
    """Lines of ``text`` as one reading has them."""
    change = _vary if moving else (lambda t, h, r: _edit(t, h, r))
    doc = F.col("doc_id")
    return F.transform(
        F.split("text", "\n"),
        lambda ln, j: F.array_join(F.transform(F.split(ln, " "), lambda t, i: change(t, doc + j + i, reading)), " "),
    )


def page_array(line_array: Column) -> Column:
    """Array of (page_number, text) of five lines each."""
    def cut(ls: Column) -> Column:
        n = F.ceil(F.size(ls) / LINES_PER_PAGE).cast("int")
        return F.transform(
            F.sequence(F.lit(1), n),
            lambda p: F.struct(p.alias("page_number"), F.array_join(F.slice(ls, (p - 1) * LINES_PER_PAGE + 1, LINES_PER_PAGE), "\n").alias("text")),
        )

    return T.let(line_array, cut)


def pages(spark: SparkSession, sf: str, reading: str | None = None, moving: bool = False) -> DataFrame:
    """doc_id, page_number, text: clean pages of the text or of one reading."""
    docs = documents(spark, sf) if reading is None else dealt(spark, sf)
    source = F.split("text", "\n") if reading is None else reading_lines(reading, moving)
    rows = docs.select("doc_id", "source", source.alias("_l"))
    return rows.select("doc_id", "source", F.explode(page_array(F.col("_l"))).alias("p")).select("doc_id", "source", "p.*")


def units(spark: SparkSession, sf: str, reading: str | None = None, moving: bool = False) -> DataFrame:
    """doc_id, unit_no, content: units of two pages with page markers above each page."""
    docs = documents(spark, sf) if reading is None else dealt(spark, sf)
    source = F.split("text", "\n") if reading is None else reading_lines(reading, moving)
    rows = docs.select("doc_id", "source", "lang", source.alias("_l")).withColumn("_p", page_array(F.col("_l"))).drop("_l")
    marked = F.transform("_p", lambda p: F.concat(F.lit("[Page "), p["page_number"].cast("string"), F.lit("]\n"), p["text"]))
    return _cut_units(rows.withColumn("_m", marked).drop("_p"), PAGES_PER_UNIT)


def _cut_units(rows: DataFrame, width: int) -> DataFrame:
    n = F.ceil(F.size("_m") / width).cast("int")
    cut = F.transform(F.sequence(F.lit(1), n), lambda u: F.struct(u.alias("unit_no"), F.array_join(F.slice("_m", (u - 1) * width + 1, width), "\n").alias("content")))
    total = n.alias("total")
    kept = [c for c in rows.columns if c != "_m"]
    return rows.select(*kept, total, F.explode(cut).alias("u")).select(*kept, "total", "u.unit_no", "u.content")


def structured_lines() -> Column:
    """Lines of ``text`` with structural lines put before some of them."""
    doc = F.col("doc_id")

    def around(ln: Column, j: Column) -> Column:
        h = doc + j
        marker = F.when((j % LINES_PER_PAGE == 0) & (h % 11 != 0), F.concat(F.lit("[Page "), (F.floor(j / LINES_PER_PAGE) + 1).cast("string"), F.lit("]")))
        extra = [F.when(h % mod == rem, line) for mod, rem, line in STRUCTURE]
        kept = F.filter(F.array(marker, *extra), lambda x: x.isNotNull())
        return F.array_join(F.concat(kept, F.array(ln)), "\n")

    return F.transform(F.split("text", "\n"), around)


def structured_units(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, unit_no, content: units of ten printed lines with structural lines among them."""
    rows = dealt(spark, sf).select("doc_id", "source", "lang", structured_lines().alias("_m"))
    return _cut_units(rows, LINES_PER_PAGE * PAGES_PER_UNIT)


def book_text(line_array: Column) -> Column:
    """One flat text of all pages, a marker above each."""
    return F.array_join(F.transform(page_array(line_array), lambda p: F.concat(F.lit("[Page "), p["page_number"].cast("string"), F.lit("]\n"), p["text"])), "\n")


# ---- the same derivations for the oracle ---------------------------------------------------


def _sql_edit(token: str, h: str, reading: str) -> str:
    cases = " ".join(f"WHEN ({h}) % {mod} = {rem} THEN {token} || '{suffix}'" for mod, rem, suffix in EDITS[reading])
    return f"CASE WHEN {token} = '' THEN {token} {cases} ELSE {token} END"


SQL_LINES = """lines AS (
  SELECT doc_id, source, lang, CAST(unnest(range(len(l))) AS INTEGER) AS line_no, unnest(l) AS line
  FROM (SELECT *, string_split(text, chr(10)) AS l FROM documents))"""


def sql_reading_lines(reading: str, name: str | None = None) -> str:
    name = name or f"l_{reading}"
    return f"""{name} AS (
  SELECT doc_id, source, lang, line_no, line AS line0,
    array_to_string(list_transform(string_split(line, ' '), lambda t, i: {_sql_edit('t', 'doc_id + line_no + i - 1', reading)}), ' ') AS line
  FROM lines)"""


def sql_pages(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT doc_id, any_value(source) AS source, CAST(line_no // 5 + 1 AS INTEGER) AS page_number,
    string_agg(line, chr(10) ORDER BY line_no) AS text
  FROM {src} GROUP BY doc_id, line_no // 5 + 1)"""


def sql_units(pages_name: str, name: str) -> str:
    return f"""{name} AS (
  SELECT doc_id, any_value(source) AS source, CAST((page_number - 1) // 2 + 1 AS INTEGER) AS unit_no,
    string_agg('[Page ' || page_number || ']' || chr(10) || text, chr(10) ORDER BY page_number) AS content
  FROM {pages_name} GROUP BY doc_id, (page_number - 1) // 2 + 1)"""


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SQL_STRUCTURED = """s_lines AS (
  SELECT doc_id, source, lang, line_no, unnest(parts) AS raw, unnest(range(len(parts))) AS part_no FROM (
    SELECT *, list_filter([CASE WHEN line_no % 5 = 0 AND (doc_id + line_no) % 11 <> 0 THEN '[Page ' || (line_no // 5 + 1) || ']' END,
      """ + ",\n      ".join(f"CASE WHEN (doc_id + line_no) % {m} = {r} THEN {_q(s)} END" for m, r, s in STRUCTURE) + """,
      line], lambda x: x IS NOT NULL) AS parts FROM lines)),
s_units AS (
  SELECT doc_id, any_value(source) AS source, CAST(line_no // 10 + 1 AS INTEGER) AS unit_no,
    string_agg(raw, chr(10) ORDER BY line_no, part_no) AS content
  FROM s_lines GROUP BY doc_id, line_no // 10 + 1),
s_rows AS (
  SELECT doc_id, unit_no, line_no, CAST(rn AS INTEGER) AS pos, trim(CASE WHEN trim(raw) LIKE '#%' THEN ltrim(trim(raw), '#') ELSE raw END) AS line FROM (
    SELECT doc_id, CAST(line_no // 10 + 1 AS INTEGER) AS unit_no, line_no, raw,
      row_number() OVER (PARTITION BY doc_id, line_no // 10 ORDER BY line_no, part_no) - 1 AS rn
    FROM s_lines)
  WHERE NOT (trim(raw) LIKE '#%' AND trim(ltrim(trim(raw), '#')) = ''))"""

SQL_FOLD = "regexp_replace(strip_accents(lower({x})), '[^\\x00-\\x7F]', '', 'g')"


def fold(x: str) -> str:
    return SQL_FOLD.format(x=x)


# kinds of structured lines, by the same ordered rules
SQL_KINDS = """s_kinds AS (
  SELECT *, CASE
    WHEN line = '' THEN 'blank'
    WHEN regexp_matches(line, '(?i)^(?:LEFT|RIGHT)\\s+PAGE\\s*:?$') THEN 'side_label'
    WHEN line LIKE '[%' AND line NOT IN ('[...]', '[section break]') AND line NOT LIKE '%[NEEDS_REVIEW%' AND line NOT LIKE '%[EXTRACTION_ERROR%'
      AND ((line LIKE '[Page %' AND NOT regexp_matches(line, '^\\[Page\\s+\\d+\\]$'))
        OR regexp_matches(line, '(?i)^\\[(?:The |This |Left|Right|Both |Blank|No |I |A |An )')
        OR regexp_matches(line, '(?i)\\b(?:blank|faint|washed.out|unclear|cannot|unable to|transcrib|not.visible|illegible)\\b')) THEN 'image_note'
    WHEN regexp_matches(line, '^\\[Page\\s+\\d+\\]$') THEN 'page_marker'
    WHEN line IN ('OPENING', 'MIDDLE PASSAGE', 'THE CLOSING WORDZ') THEN 'chapter_heading'
    WHEN regexp_matches(line, '^\\d{1,4}$') AND try_cast(line AS INTEGER) BETWEEN 1 AND 500 THEN 'bare_number'
    WHEN line = 'COLLECTED WITNESSES' THEN 'running_header'
    WHEN regexp_matches(line, '(?i)^\\[?(section break|decorative break|ornament(?:al)? break?|small square|ornament|divider)\\]?$') THEN 'section_break'
    WHEN regexp_matches(line, '^[IVX]+$') THEN 'section_number'
    WHEN regexp_matches(line, '^[*_]') THEN 'italic_block'
    WHEN line LIKE '%[NEEDS_REVIEW%' OR line LIKE '%[EXTRACTION_ERROR%' THEN 'needs_review'
    WHEN line = '[...]' THEN 'gutter_gap'
    ELSE 'text' END AS kind,
    CASE line WHEN 'OPENING' THEN 'opening' WHEN 'MIDDLE PASSAGE' THEN 'middle' WHEN 'THE CLOSING WORDZ' THEN 'closing' END AS chapter
  FROM s_rows)"""


def sql(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
