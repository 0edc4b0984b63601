"""Secret scans: a trigram inverted index finds the candidates of each rule, its regex verifies them.

Each rule's regex gives a Boolean query over trigrams that every match must hold, by walking
its parse tree.  Documents are indexed block by block (an Arrow batch): a posting list per
trigram that some rule asks for.  Posting lists are intersected and united as the query says,
and only the documents left are searched with the regex.  A rule without a mandatory trigram
scans every document.  A block's index lives in the task that reads the block, so nothing is
shuffled and no list is longer than a block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of the pattern whose `group` has `least` characters or more."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    either_case: bool = False

    def compiled(self) -> re.Pattern[str]:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.either_case else 0))


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
ADDED = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("upper_hex", r"[0-9A-F]{32,}"),
)
RULES = BASE + ADDED

# a query is None (anything), a trigram, or ("and" | "or", parts)
Query = None | str | tuple[str, frozenset]


def _join(op: str, parts: list[Query]) -> Query:
    if op == "or" and None in parts:
        return None
    parts = {x for x in parts if x is not None}
    return None if not parts else next(iter(parts)) if len(parts) == 1 else (op, frozenset(parts))


def _held(texts: set[str]) -> Query:
    """The query that any of the texts is there."""
    return _join("or", [_join("and", [t[i : i + 3] for i in range(len(t) - 2)]) for t in texts])


def _known(op: object, arg: object, most: int = 16) -> set[str] | None:
    """All texts that a parse node can match, in lower case; None if they are many."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN":
        out: set[str] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                out.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < most:
                out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= most else None
    if name == "SUBPATTERN":
        return _all(arg[3])
    if name == "BRANCH":
        each = [_all(x) for x in arg[1]]
        return None if None in each else set().union(*each)
    if name == "MAX_REPEAT" and arg[1] == 1:
        inner = _all(arg[2])
        return None if inner is None else inner | {""} if arg[0] == 0 else inner
    return None


def _all(nodes: object, most: int = 64) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        more = _known(op, arg)
        if more is None or len(out) * len(more) > most:
            return None
        out = {a + b for a in out for b in more}
    return out


def _query(nodes: object) -> Query:
    parts: list[Query] = []
    held = {""}
    for op, arg in nodes:
        more = _known(op, arg)
        if more is not None and len(held) * len(more) <= 64:
            held = {a + b for a in held for b in more}
            continue
        parts.append(_held(held))
        held = {""}
        name = str(op)
        if name == "SUBPATTERN":
            parts.append(_query(arg[3]))
        elif name == "BRANCH":
            parts.append(_join("or", [_query(x) for x in arg[1]]))
        elif name == "MAX_REPEAT" and arg[0] >= 1:
            parts.append(_query(arg[2]))
    return _join("and", [*parts, _held(held)])


def trigram_query(rule: Rule) -> Query:
    """The Boolean trigram query, over text in lower case, that every match of the rule fulfils."""
    return _query(_parser.parse(rule.pattern, re.ASCII))


def trigrams(query: Query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams(x) for x in query[1]))


def candidates(query: Query, postings: dict[str, np.ndarray], n: int) -> np.ndarray:
    """The documents of a block of n that fulfil the query."""
    if query is None:
        return np.arange(n)
    if isinstance(query, str):
        return postings[query]
    lists = sorted((candidates(x, postings, n) for x in query[1]), key=len, reverse=query[0] == "or")
    out = lists[0]
    for x in lists[1:]:
        out = np.intersect1d(out, x, assume_unique=True) if query[0] == "and" else np.union1d(out, x)
    return out


_FOLD = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _scan(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...]) -> Iterator[pa.RecordBatch]:
    plans = [(r, trigram_query(r), r.compiled()) for r in rules]
    wanted = sorted(set().union(*(trigrams(q) for _, q, _ in plans)))
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        hold: dict[str, list[int]] = {g: [] for g in wanted}
        for i, t in enumerate(texts):
            t = t.lower() if t.isascii() else t.translate(_FOLD)
            for g in wanted:
                if g in t:
                    hold[g].append(i)
        postings = {g: np.array(x, np.int64) for g, x in hold.items()}
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for order, (rule, query, regex) in enumerate(plans):
            for i in candidates(query, postings, len(texts)).tolist():
                for m in regex.finditer(texts[i]):
                    if len(m[rule.group]) >= rule.least:
                        found[i].append((m.start(), order, m.end()))
        spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(x)] for x in found]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["id", "spans"])


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, spans: one row per row of `docs`, its secrets as (kind, start, end) by start, then by rule.

    Positions are code points, the end exclusive.  A null or empty text has no span; repeated
    rows give theirs each.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return rows.mapInArrow(lambda b: _scan(b, rules), schema).withColumnRenamed("id", id_col)
