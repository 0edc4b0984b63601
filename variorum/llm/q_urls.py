"""Queries over page addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variorum.llm import sqltext, urls
from variorum.llm.queries import query, table

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
_VALUES = ", ".join(f"('{k[: k.index('/')]}', '{k[k.index('/') :]}', '{v}')" for k, v in RULES)

RULE_SQL = f"""WITH cut AS (SELECT page_id, {sqltext.lower("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(h, p, v) AS (VALUES {_VALUES}),
hits AS (SELECT page_id, arg_max(h || p, [length(h) + length(p), length(h)]) AS rule, arg_max(v, [length(h) + length(p), length(h)]) AS v
    FROM cut JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM cut LEFT JOIN hits USING (page_id)"""


#: hosts of casinos, bets, link farms, pills and adult pages, with their subdomains
BLOCKED = [(f"{name}.example.{top}/", "block") for name in ("casino-win", "free-bets", "spam-farm", "cheap-pills", "adult-x") for top in ("com", "net", "org")]
_HOSTS = ", ".join(f"('{k[:-1]}')" for k, _ in BLOCKED)

BLOCK_SQL = f"""WITH ruled AS ({RULE_SQL}), listed(h) AS (VALUES {_HOSTS})
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL AND starts_with(path, '/')
    AND EXISTS (SELECT 1 FROM listed WHERE host = h OR ends_with(host, '.' || h)) THEN 'block' ELSE verdict END AS verdict FROM ruled"""


@query("op8_url_blocklist", BLOCK_SQL)
@query("op8_url_filter", BLOCK_SQL)
def url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The rule and verdict of every page's address; the cascade of a block list decides where no rule fits."""
    listed = spark.createDataFrame(BLOCKED, "key string, verdict string")
    return urls.judged(table(spark, sf, "pages"), RULES, listed=listed)
