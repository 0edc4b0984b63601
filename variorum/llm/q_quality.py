"""Query over document quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variorum.llm import quality, sqltext
from variorum.llm.queries import query, table

_BREAKS = " OR ".join(
    f"({r.measure} {op} {bound})" for r in quality.RULES for op, bound in (("<", r.low), (">", r.high)) if bound is not None
)
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))


def counts_sql(docs: str) -> str:
    """CTEs ending in `judged`: every document's counts and verdict."""
    return f"""
cut AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text, {sqltext.words("text")} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{sqltext.WORD}')) AS ls FROM {docs}),
grams AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM cut)),
twice AS (SELECT doc_id, g FROM grams GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM grams JOIN twice USING (doc_id, g), (VALUES (0), (1), (2)) t(k) GROUP BY doc_id),
counted AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(ws, lambda x: regexp_replace(lower(x), '[.,;:!?]+$', '') IN ({_STOP}))) AS n_stop,
    len(list_filter(ws, lambda x: regexp_matches(x, '[!?#*$%&|<>~^]$'))) AS n_marked FROM cut LEFT JOIN covered USING (doc_id)),
rated AS (SELECT *, coalesce(100.0 * n_repeat_words / nullif(n_words, 0), 0) AS repeat_pct, coalesce(1.0 * word_chars / nullif(n_words, 0), 0) AS mean_word_chars,
    coalesce(100.0 * n_symbols / nullif(word_chars, 0), 0) AS symbol_pct, coalesce(100.0 * n_stop / nullif(n_words, 0), 0) AS stop_pct,
    coalesce(100.0 * n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_pct, coalesce(100.0 * n_marked / nullif(n_words, 0), 0) AS marked_pct FROM counted),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT ({_BREAKS}) AND NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS kept FROM rated)"""


QUALITY_SQL = f"WITH {counts_sql('documents')} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"


@query("op2_quality_rules", QUALITY_SQL)
def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The counts of every document and whether the threshold table keeps it."""
    judged = quality.judge(table(spark, sf, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
