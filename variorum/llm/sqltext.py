"""Pieces of DuckDB SQL that several oracles share."""

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    """List of the words of a text expression; null has none."""
    return f"regexp_extract_all(coalesce({text}, ''), '{WORD}')"


def lower(text: str) -> str:
    """The text with A-Z in lower case and all else as it is."""
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def near_groups(docs: str, shingle: int, percent: int) -> str:
    """CTEs ending in `placed` (doc_id, n, component): exact near-duplicate components over a relation."""
    ws = words(lower("text"))
    gram = " || ' ' || ".join(f"ws[i + {k}]" if k else "ws[i]" for k in range(shingle))
    return f"""
cut AS MATERIALIZED (SELECT doc_id, {ws} AS ws FROM {docs}),
sets AS MATERIALIZED (SELECT doc_id, list_sort(CASE WHEN len(ws) >= {shingle} THEN list_distinct(list_transform(range(1, len(ws) - {shingle} + 2), lambda i: {gram}))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS members FROM cut),
classes AS MATERIALIZED (SELECT min(doc_id) AS rep, members, len(members) AS n FROM sets WHERE len(members) > 0 GROUP BY members),
rows_ AS MATERIALIZED (SELECT rep, n, unnest(members) AS g FROM classes),
pairs AS MATERIALIZED (SELECT a.rep AS x, b.rep AS y FROM rows_ a JOIN rows_ b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
    GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
edges AS MATERIALIZED (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
reach(x, y) AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
lowest AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
placed AS (SELECT s.doc_id, len(s.members) AS n, coalesce(least(c.rep, l.y), c.rep, s.doc_id) AS component
    FROM sets s LEFT JOIN classes c ON s.members = c.members AND len(s.members) > 0 LEFT JOIN lowest l ON l.x = c.rep)"""
