"""One page after another: what a page keeps when its predecessors' results are known (K1-K3).

The step of `dedup.deduplicate` in Python, for the few pages that follow a changed one; all
others take the result that was worked out in Spark.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa

from variorum.functions import align as A
from variorum.params import Params

_LATIN = re.compile("[a-zA-ZÀ-ÿ'’-]+")
# what the JVM takes for white space
_GAP = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")

Blocks = list[dict]


class Page:
    """A page's blocks with what later pages compare with, made when asked for."""

    def __init__(self, blocks: Blocks, changed: bool):
        self.blocks, self.changed = blocks, changed
        self._tokens: list[str] | None = None
        self._sets: list[set[str]] | None = None

    @property
    def tokens(self) -> list[str]:
        if self._tokens is None:
            self._tokens = latin(" ".join(b["text"] or "" for b in self.blocks or () if b["type"] == "paragraph"))
        return self._tokens

    @property
    def sets(self) -> list[set[str]]:
        if self._sets is None:
            self._sets = [set(latin(b["text"] or "")) for b in self.blocks or () if b["type"] == "paragraph"]
        return self._sets


def latin(text: str) -> list[str]:
    return _LATIN.findall(text.lower())


def overlap(tail: list[str], head: list[str], p: Params) -> tuple[int, int]:
    """Where the head repeats the tail, and for how many words."""
    a, b = tail[-p.overlap_sample :], head[: p.overlap_sample]
    best = (0, 0)
    for m in A._Matcher(a, b).get_matching_blocks():
        if m.size > best[1] and m.size >= p.overlap_min_words and m.b <= p.overlap_max_head and m.a + m.size >= len(a) - p.overlap_tail_reach:
            best = m.b, m.size
    return best


def trimmed(blocks: Blocks, offset: int, n: int) -> Blocks:
    """Blocks without n paragraph words from offset on; emptied paragraphs go."""
    out, at = [], 0
    for b in blocks:
        if b["type"] != "paragraph" or b["text"] is None:
            out.append(b)
            continue
        words = [w for w in _GAP.split(b["text"]) if w]
        hit = at + len(words) > offset and at < offset + n
        kept = words[: max(0, offset - at)] + words[max(0, offset + n - at) :] if hit else words
        at += len(words)
        if kept or not hit:
            out.append({"type": b["type"], "text": " ".join(kept) if hit else b["text"]})
    return out


def repeats(text: str | None, prior: list[set[str]], p: Params) -> bool:
    """Whether a block is long enough and close to an earlier one."""
    tokens = latin(text) if text is not None else []
    mine = set(tokens)
    return len(tokens) >= p.block_min_words and any(x and len(x & mine) / max(len(x), len(mine)) >= p.block_min_sim for x in prior)


def step(blocks: Blocks, window: deque[Page], first: Page | None, p: Params) -> tuple[Blocks, str, int]:
    """A page's blocks after its predecessors; `window` has the last ones, the latest at its end."""
    tail, head = window[-1].tokens, Page(blocks, False).tokens
    if not tail or not head:
        return blocks, "kept", 0
    start, n = overlap(tail, head, p)
    if n >= p.overlap_min_words and n / min(len(tail), len(head), p.overlap_ratio_window) >= p.overlap_min_ratio:
        return trimmed(blocks, start, n), "overlap", n
    prior = []
    for d in range(2, p.lookback + 2):
        page = window[-d] if d <= len(window) else first
        prior += page.sets if page else []
    kept = [b for b in blocks if b["type"] != "paragraph" or not repeats(b["text"], prior, p)]
    return kept, "repeat" if len(kept) < len(blocks) else "kept", 0


def passed(batches: Iterator[pa.RecordBatch], n_keys: int, p: Params) -> Iterator[pa.RecordBatch]:
    """Rows of one segment after another, with the results of pages after a changed one worked out again; `new` counts where `changed`."""
    window: deque[Page] = deque(maxlen=p.lookback + 1)
    now, first = None, None
    for batch in batches:
        at = {c: i for i, c in enumerate(batch.schema.names)}
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(n_keys)), strict=True))
        own, index, changed = (batch.column(at[c]).to_pylist() for c in ("_own", "_idx", "changed"))
        anew: dict[int, tuple[Blocks, str, int, bool]] = {}
        for i, key in enumerate(keys):
            if key != now:
                window.clear()
                now, first = key, None
            orig = lambda i=i: batch.column(at["orig"])[i].as_py()
            if not own[i]:
                page = Page(orig(), False)
            elif window and any(x.changed for x in window):
                blocks = orig()
                new, action, n = step(blocks, window, first, p) if blocks is not None else (None, "kept", 0)
                page = Page(new, new != blocks)
                anew[i] = new, action, n, page.changed
            else:
                page = Page(batch.column(at["new"])[i].as_py() if changed[i] else orig(), changed[i])
            window.append(page)
            if index[i] == 0:
                first = page
        columns = {c: batch.column(k) for c, k in at.items()}
        if anew:
            for k, c in enumerate(("new", "action", "n_trimmed", "changed")):
                values = columns[c].to_pylist()
                for i, row in anew.items():
                    values[i] = row[k]
                columns[c] = pa.array(values, columns[c].type)
        out = pa.RecordBatch.from_pydict({c: columns[c] for c in batch.schema.names if c != "_own"})
        yield out.filter(batch.column(at["_own"]))
