"""Query over phrases that occur more often than their parts let expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variorum.llm import phrases, sqltext
from variorum.llm.queries import query, table

PHRASE_SQL = f"""WITH pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({sqltext.lower("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
grams AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4), (5)) t(k))),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
cuts AS MATERIALIZED (SELECT c.*, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j + 1:], ' ') AS y
    FROM (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS j FROM f WHERE k > 1) c),
scored AS MATERIALIZED (SELECT c.lang, c.k, c.phrase, c.a, j, x, y, p.a AS l, q.a AS r, n, ((1000::HUGEINT * c.a * n) // (p.a::HUGEINT * q.a))::BIGINT AS score
    FROM cuts c JOIN f p ON p.lang = c.lang AND p.phrase = c.x AND p.k = c.j JOIN f q ON q.lang = c.lang AND q.phrase = c.y AND q.k = c.k - c.j JOIN totals t ON t.lang = c.lang),
best AS (SELECT lang, phrase, any_value(a) AS a, arg_min(l, [score, j]) AS l, arg_min(r, [score, j]) AS r, any_value(n) AS n, min(score) AS score FROM scored GROUP BY lang, phrase),
covered AS (SELECT lang, part, max(a) AS longer FROM (SELECT lang, x AS part, a FROM scored WHERE j = k - 1 UNION ALL SELECT lang, y, a FROM scored WHERE j = 1) GROUP BY lang, part),
kept AS (SELECT b.* FROM best b LEFT JOIN covered c ON c.lang = b.lang AND c.part = b.phrase WHERE coalesce(c.longer, 0) < b.a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000"""


@query("op12_phrase_collocations", PHRASE_SQL)
def phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """The best phrases of every language."""
    return phrases.collocations(table(spark, sf, "documents"))
