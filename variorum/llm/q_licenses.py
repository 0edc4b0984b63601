"""Query over licenses."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from variorum.llm import licenses
from variorum.llm.queries import query, table

P = licenses.Scan()


def _tokens(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


_ROWS = ", ".join(
    f"({i}, '{name}', {P.width(len(_tokens(text)))}, {sorted({' '.join(_tokens(text)[k : k + P.shingle]) for k in range(len(_tokens(text)) - P.shingle + 1)})})"
    for i, (name, text) in enumerate(licenses.TEMPLATES)
)

LICENSE_SQL = f"""WITH templates(template, license, width, grams) AS (VALUES {_ROWS}),
own AS (SELECT template, license, width, len(grams) AS size, unnest(grams) AS g FROM templates),
cut AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS t FROM documents),
said AS (SELECT doc_id, i, t[i + 1] || ' ' || t[i + 2] || ' ' || t[i + 3] AS g FROM (SELECT doc_id, t, unnest(range(len(t) - {P.shingle - 1})) AS i FROM cut)),
hits AS (SELECT doc_id, template, license, size, width, i, g FROM said JOIN own USING (g)),
placed AS (SELECT doc_id, license, template, size, g, i // width - k AS w FROM hits, (VALUES (0), (1)) s(k) WHERE i // width >= k AND i < (i // width - k) * width + 2 * width - {P.shingle - 1}),
held AS (SELECT doc_id, license, count(DISTINCT g) / size AS containment FROM placed GROUP BY doc_id, license, template, size, w)
SELECT doc_id, license, max(containment) AS containment FROM held WHERE containment >= {P.held} GROUP BY doc_id, license"""


@query("op6_license_scan", LICENSE_SQL)
def license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The licenses that every document names or grants."""
    return licenses.licenses(table(spark, sf, "documents"))
