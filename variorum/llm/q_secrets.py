"""Query over secrets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variorum.llm import secrets
from variorum.llm.queries import query, table


def _places(rule: secrets.Rule, order: int) -> str:
    """SQL for the spans of one rule: the lengths of what lies between the matches and of the matches add up to positions."""
    pattern = ("(?i)" if rule.either_case else "") + rule.pattern
    pattern = pattern.replace("'", "''")
    return f"""SELECT doc_id, {order} AS o, '{rule.kind}' AS kind, a AS start, a + length(m[i]) AS stop FROM (
    SELECT doc_id, m, i, (list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS a FROM (
        SELECT doc_id, m, s, unnest(range(1, len(m) + 1)) AS i FROM (
            SELECT doc_id, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS s FROM docs)))
    WHERE length(regexp_extract(m[i], '{pattern}', {rule.group})) >= {rule.least}"""


SECRET_SQL = f"""WITH docs AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS MATERIALIZED ({" UNION ALL ".join(_places(r, k) for k, r in enumerate(secrets.RULES))}),
lists AS (SELECT doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) FILTER (o < {len(secrets.BASE)}) AS base, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN lists USING (doc_id)"""


@query("op9_secret_scan", SECRET_SQL)
def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The secrets of every document, counted by kind and listed."""
    found = secrets.secrets(table(spark, sf, "documents"))
    base = [r.kind for r in secrets.BASE]
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of = lambda k: F.filter("spans", lambda x: x["kind"].isin(k))
    return found.select(
        "doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in base), F.sha2(joined(of(base)), 256).alias("base_sha256"), joined("spans").alias("spans")
    )
