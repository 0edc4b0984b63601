"""Query over repeated passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variorum.llm import sqltext, substrings
from variorum.llm.queries import query, table

SUBSTRING_SQL = f"""WITH cut AS MATERIALIZED (SELECT doc_id, {sqltext.words("text")} AS ws FROM documents),
win AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM cut)),
firsts AS (SELECT g, min(doc_id) AS owner FROM win GROUP BY g),
bad AS (SELECT doc_id, list(i) AS hits FROM win JOIN firsts USING (g) WHERE owner < doc_id GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM (SELECT doc_id, unnest(hits) AS i FROM bad), (SELECT unnest(range(50)) AS k)),
flags AS (SELECT doc_id, list(pos) AS pos FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS text, count(*) AS n FROM (SELECT doc_id, j, ws[j] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS j FROM cut)) a
    WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = a.doc_id AND g.pos = a.j) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM cut LEFT JOIN kept USING (doc_id)"""


@query("op10_substring_dedup", SUBSTRING_SQL)
def substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What stays of every document when passages of 50 words that an earlier one has are gone."""
    return substrings.deduplicated(table(spark, sf, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
