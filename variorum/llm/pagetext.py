"""HTML extraction: block structure first, then a suffix array over the pages of a host.

Each page is cut into blocks of text with what encloses them.  Blocks of markup that is never
main text go; of a page with an article or main element only the blocks inside stay.  Then the
blocks of a host's pages are laid end to end as streams of word ids, and a suffix array (by
prefix doubling) finds the word runs that many distinct pages of the host share.  Runs that
it covers are boilerplate; the unique runs between them are the text.

A large host's array is made in parts and merged: its pages are dealt by their words, each part
sorts its own suffixes and names the runs that could be in enough of the host's pages, and these
are counted in all parts.  "Many" is a share of all distinct pages of the host.  Pages with the
same words count as one, and a page of which the array covers half is a copy, not a frame: it
keeps everything.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variorum.llm import store, words
from variorum.llm.urls import host_of


@dataclass(frozen=True)
class Extract:
    """Words of a shared run, and the share of a host's distinct pages that must have it.

    `inside` is the share asked of blocks within an article or main element, `outside` that of
    blocks of pages without one; `least` is the fewest pages.  A host over `cell` bytes of html is
    dealt into parts of about that size and of `pages` pages or more, over several tasks; at most
    `hosts` hosts are, the rest are one part each, however large.
    """

    run: int = 8
    inside: float = 0.5
    outside: float = 0.1
    least: int = 3
    cell: int = 1 << 20
    pages: int = 64
    hosts: int = 4096


# fixed values: elements by their part in a page
RAW = ("script", "style", "template", "noscript", "iframe", "textarea", "svg", "math", "title", "object")
NOISE = ("nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "audio", "video", "canvas", "head")
MAIN = ("article", "main")
INLINE = (
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
)
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
# fixed values: words of class, id and role that mark what is not main text
MARKS = (
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo",
    "cookie", "cookies", "disqus", "footer", "masthead", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo",
    "related", "respond", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "widget",
)

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>(?:(?!</(?P=raw)[\s/>]).)*+(?:</(?P=raw)[^>]*>?|\Z)"
    r"|<(?P<shut>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<shut2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*[\"']?true", re.I)
_INLINE, _VOID, _NOISE, _MAIN, _MARKS = map(frozenset, (INLINE, VOID, NOISE, MAIN, MARKS))


def _noise(tag: str, rest: str, main: bool) -> bool:
    """Whether an element is not main text, by name or by its marks."""
    if tag in _NOISE or tag == "header" and not main:
        return True
    if tag in ("html", "body", *MAIN) or not rest:
        return False
    marks = {w for m in _MARKED.finditer(rest) for w in re.split(r"[^a-z]+", (m[1] or m[2] or m[3] or "").lower())}
    return bool(marks & _MARKS) or bool(_HIDDEN.search(rest))


def blocks(page: str) -> tuple[list[str], bool]:
    """The text blocks of a page that may be its main text, and whether an article or main element holds them."""
    out: list[tuple[str, bool]] = []
    held: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # tag, noise, main: of it and what encloses it
    noise = main = False

    def end() -> None:
        if held:
            text = " ".join(unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((text, main))

    for m in _TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            if not noise:
                held.append(text)
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            if m["raw"]:  # the element goes with what it holds
                held.append(" ") if held else None
            continue
        if tag in _INLINE:
            if not noise and not m["shut"] and not m["shut2"] and _noise(tag, m["rest"] or m["rest2"] or "", main):
                end()
                open_.append((tag, True, main))
                noise = True
            elif (m["shut"] or m["shut2"]) and open_ and open_[-1][0] == tag:
                open_.pop()
                noise = open_[-1][1] if open_ else False
            continue
        if not noise:
            end()
        if m["shut"] or m["shut2"]:
            at = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == tag), None)
            if at is not None:
                del open_[at:]
        elif tag not in _VOID:
            if tag == "p" and open_ and open_[-1][0] == "p":
                open_.pop()
            noise, main = (open_[-1][1], open_[-1][2]) if open_ else (False, False)
            # an article among the comments, or in a list of others, is no main text
            open_.append((tag, noise or _noise(tag, m["rest"] or m["rest2"] or "", main), main or tag in _MAIN))
        noise, main = (open_[-1][1], open_[-1][2]) if open_ else (False, False)
    end()
    inside = any(x for _, x in out)
    return [t for t, x in out if x or not inside], inside


def suffix_order(ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of a stream of ids to a depth, and each suffix's rank; equal to the depth is equal in rank."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    have = 1
    while have < depth:
        step = min(have, depth - have)  # the last round overlaps, so that the depth is exact
        after = np.full(n, -1, np.int64)
        after[: n - step] = rank[step:]
        rank = np.unique(rank * np.int64(n + 1) + (after + 1), return_inverse=True)[1].astype(np.int64)
        have += step
    return np.argsort(rank, kind="stable"), rank


def _apart(streams: list[np.ndarray]) -> tuple[list[int], list[np.ndarray]]:
    """For each page the number of its words' first page, and the distinct pages: pages with the same words are one."""
    first: dict[bytes, int] = {}
    same = [first.setdefault(s.tobytes(), len(first)) for s in streams]
    at: dict[int, int] = {}
    for i, k in enumerate(same):
        at.setdefault(k, i)
    return same, [streams[at[k]] for k in range(len(first))]


def _fits(sizes: np.ndarray, run: int) -> np.ndarray:
    """Of all words of pages laid end to end, whether a run that starts there ends within its page."""
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(int(sizes.sum()))
    return left >= run


def _pages_of_runs(kept: list[np.ndarray], run: int) -> np.ndarray:
    """How many of these distinct pages have the run that starts at each of their words, laid end to end; 0 where none fits."""
    sizes = np.array([len(s) for s in kept])
    # between two pages stands an id that no other place has, so that no run goes over it
    begin = np.cumsum(sizes + 1) - sizes - 1
    page = np.repeat(np.arange(len(kept)), sizes + 1)
    ids = np.concatenate([np.append(s, np.uint64(0)) for s in kept])
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    ends = begin + sizes
    rank[ends] = rank.max() + 1 + np.arange(len(kept))
    order, rank = suffix_order(rank, run)
    pairs = np.unique(rank[order] * np.int64(len(kept)) + page[order])
    pages = np.bincount(pairs // len(kept), minlength=int(rank.max()) + 1)
    return np.where(_fits(sizes, run), np.delete(pages[rank], ends), 0)


def _need(share: float, pages: int, least: int) -> int:
    return max(least, int(np.ceil(share * pages)))


def _gone(seen: np.ndarray, sizes: np.ndarray, inside: np.ndarray, pages: int, p: Extract) -> list[np.ndarray]:
    """For each page which of its words lie in a run of enough of the host's `pages`, given how many have the run at each word."""
    hit = np.flatnonzero(seen >= np.where(np.repeat(inside, sizes), _need(p.inside, pages, p.least), _need(p.outside, pages, p.least)))
    edge = np.bincount(hit, minlength=len(seen) + p.run) - np.bincount(hit + p.run, minlength=len(seen) + p.run)
    covered = np.cumsum(edge)[: len(seen)] > 0
    cut = np.split(covered, np.cumsum(sizes)[:-1])
    return [np.zeros(len(c), bool) if x and 2 * c.sum() >= len(c) else c for c, x in zip(cut, inside, strict=True)]


def shared_words(streams: list[np.ndarray], inside: np.ndarray, p: Extract) -> list[np.ndarray]:
    """For each page of a host, which of its words lie in a run that many distinct pages have."""
    same, kept = _apart(streams)
    if len(kept) < p.least:
        return [np.zeros(len(s), bool) for s in streams]
    seen = np.split(_pages_of_runs(kept, p.run), np.cumsum([len(s) for s in kept])[:-1])
    return _gone(np.concatenate([seen[k] for k in same]), np.array([len(s) for s in streams]), inside, len(kept), p)


def _run_keys(streams: list[np.ndarray], run: int) -> np.ndarray:
    """A 64-bit hash of the run of words that starts at each word of pages laid end to end, over their ends too."""
    ids = np.concatenate([*streams, np.zeros(run - 1, np.uint64)])
    n = len(ids) - run + 1
    key = np.zeros(n, np.uint64)
    for i in range(run):
        key = key * np.uint64(words.BASES[0]) + ids[i : i + n]
    return words.mix(key).view(np.int64)


def often_in_part(streams: list[np.ndarray], p: Extract) -> tuple[int, np.ndarray]:
    """A part's distinct pages, and the keys of runs that so many of them have that the host's may be enough.

    A run that a share of the host's distinct pages has is in that share of them in at least one
    part, as no two parts have the same page; so no run of the host's array is missed.
    """
    _, kept = _apart(streams)
    seen = _pages_of_runs(kept, p.run)
    enough = max(1, int(np.ceil(min(p.inside, p.outside) * len(kept) * (1 - 1e-12))))
    return len(kept), np.unique(_run_keys(kept, p.run)[seen >= enough])


def _found(keys: np.ndarray, streams: list[np.ndarray], run: int) -> np.ndarray:
    """Where in the sorted `keys` the run at each word of pages laid end to end stands; -1 if nowhere."""
    mine = _run_keys(streams, run)
    at = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
    return np.where((keys[at] == mine) & _fits(np.array([len(s) for s in streams]), run), at, -1)


def pages_in_part(keys: np.ndarray, streams: list[np.ndarray], p: Extract) -> np.ndarray:
    """How many distinct pages of a part have each run of the sorted `keys`."""
    _, kept = _apart(streams)
    at = _found(keys, kept, p.run)
    page = np.repeat(np.arange(len(kept)), [len(s) for s in kept])
    pairs = np.unique((at * np.int64(len(kept)) + page)[at >= 0])
    return np.bincount(pairs // len(kept), minlength=len(keys))


_ROW = "ids array<long>, urls array<string>, host string, inside boolean, blocks array<string>, content long"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of pages; those of a batch that agree in host and blocks are one row with the list of their ids and URLs."""
    for batch in words.slices(batches, "html"):
        rows: dict[tuple[str, bool, tuple[str, ...]], tuple[list[int], list[str]]] = {}
        for id_, url, host, page in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "host", "html")), strict=True):
            found, inside = blocks(page or "")
            ids, urls = rows.setdefault((host, inside, tuple(found)), ([], []))
            ids.append(id_)
            urls.append(url)
        # the same words have the same hash, however they lie in blocks
        content = [int.from_bytes(blake2b(" ".join(k[2]).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) for k in rows]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([v[0] for v in rows.values()], pa.list_(pa.int64())), pa.array([v[1] for v in rows.values()], pa.list_(pa.string())),
                pa.array([k[0] for k in rows], pa.string()), pa.array([k[1] for k in rows], pa.bool_()),
                pa.array([list(k[2]) for k in rows], pa.list_(pa.string())), pa.array(content, pa.int64()),
            ],
            names=["ids", "urls", "host", "inside", "blocks", "content"],
        )


def _streams(found: list[list[str]]) -> list[np.ndarray]:
    """Each page's words as ids."""
    w = words.cut(pa.array([" ".join(b) for b in found], pa.large_string()))
    ids = w.hash()
    return [ids[i:j] for i, j in zip(w.first[:-1], w.first[1:], strict=True)]


def _texts(pages: pa.Table, frequent: pa.Table, p: Extract) -> pa.Table:
    """The pages of a host, or of a part of one with the host's frequent runs, with their text."""
    found = pages.column("blocks").to_pylist()
    streams, inside = _streams(found), pages.column("inside").to_numpy()
    if not pages.column("parted")[0].as_py():
        cut = shared_words(streams, inside, p)
    elif not frequent.num_rows:
        cut = [np.zeros(len(s), bool) for s in streams]
    else:
        keys, n = (np.array(frequent.column(c)[0].as_py(), np.int64) for c in ("keys", "counts"))
        order = np.argsort(keys)
        at = _found(keys[order], streams, p.run)
        seen = np.where(at >= 0, n[order][at], 0)
        cut = _gone(seen, np.array([len(s) for s in streams]), inside, frequent.column("pages")[0].as_py(), p)
    texts = []
    for b, gone in zip(found, cut, strict=True):
        if gone.any():
            b = [" ".join(b).split(" ")[i] for i in np.flatnonzero(~gone)]
        texts.append(" ".join(b))
    return pa.table([*(pages.column(c) for c in ("ids", "urls")), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["ids", "urls", "text", "n_chars"])


def _cells(batches: Iterator[pa.RecordBatch], p: Extract) -> Iterator[list[pa.RecordBatch]]:
    """Rows of one host and salt, in order, cut to about the size of a cell; a short end joins the cell before."""
    held: list[pa.RecordBatch] = []
    size, now, before = 0, None, None
    for batch in batches:
        bytes_ = pc.fill_null(pc.binary_length(pc.binary_join(batch.column("blocks"), " ")), 0).to_numpy(zero_copy_only=False)
        host, salt = batch.column("host").to_pylist(), batch.column("salt").to_pylist()
        at = 0
        for i in range(batch.num_rows):
            if (host[i], salt[i]) != now:
                if i > at:
                    held.append(batch.slice(at, i - at))
                    at = i
                if before and held and size < p.cell // 2:
                    yield before + held
                else:
                    yield from (x for x in (before, held) if x)
                held, before, size, now = [], None, 0, (host[i], salt[i])
            elif size >= p.cell:
                held.append(batch.slice(at, i - at)) if i > at else None
                at = i
                if before:
                    yield before
                before, held, size = held, [], 0
            size += int(bytes_[i])
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if before and held and size < p.cell // 2:
        yield before + held
    else:
        yield from (x for x in (before, held) if x)


def extracted(pages: DataFrame, params: Extract | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id_col, url_col, text, n_chars: the main text of every row of `pages`, and its code points.

    Character references are decoded, white space within a block becomes one space, blocks are
    joined in order by one space.  A null or empty page, or one without main text, has an empty
    text.  A null URL, or one without `://`, belongs to the host without a name.  Rows that repeat
    are pages of their own but count once as evidence.  Markup that does not close ends with the
    page.  Other columns are not read.
    """
    p = params or Extract()
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    size = F.sum(F.length("html").cast("long"))
    total = rows.agg(F.coalesce(size, F.lit(0))).first()[0]
    # no more than `hosts` hosts can hold so much each
    large = rows.groupBy("host").agg(size.alias("size"), F.count("*").alias("n")).filter(F.col("size") >= max(p.cell, -(-total // p.hosts)))
    salts = F.least(F.ceil(F.col("size") / F.lit(float(p.cell))), F.floor(F.col("n") / F.lit(float(p.pages)))).cast("long")
    large = store.cut(large.select("host", salts.alias("salts")).filter("salts > 1"))
    found = rows.select("id", "url", "host", "html").mapInArrow(_parsed, _ROW).join(F.broadcast(large), "host", "left")
    salt = F.pmod("content", F.coalesce("salts", F.lit(1)))
    found = found.select("ids", "urls", "host", salt.alias("salt"), F.col("salts").isNotNull().alias("parted"), "inside", "blocks")
    # read three times, each time with all columns, so that Spark shuffles it once
    dealt = found.repartition("host", "salt")
    parts = dealt.groupBy("host", "salt")

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches, replace(p, cell=1 << 62)):
            if cell[0].column("parted")[0].as_py():
                n, keys = often_in_part(_streams([b for x in cell for b in x.column("blocks").to_pylist()]), p)
                host = cell[0].column("host")[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * (len(keys) + 1), pa.string()), pa.array([None, *keys.tolist()], pa.int64()), pa.array([n, *[0] * len(keys)], pa.int64())], names=["host", "key", "pages"]
                )

    def count(pages: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows or not pages.num_rows:
            return pa.table([pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.int64())], names=["host", "key", "n", "pages"])
        keys = np.sort(np.array(asked.column("keys")[0].as_py(), np.int64))
        n = pages_in_part(keys, _streams(pages.column("blocks").to_pylist()), p) if len(keys) else keys
        keys, n = keys[n > 0], n[n > 0]
        host, all_ = asked.column("host")[0].as_py(), asked.column("pages")[0].as_py()
        return pa.table([pa.array([host] * len(keys), pa.string()), pa.array(keys), pa.array(n, pa.int64()), pa.array([all_] * len(keys), pa.int64())], names=["host", "key", "n", "pages"])

    def text(pages: pa.Table, frequent: pa.Table) -> pa.Table:
        if not pages.num_rows:
            pages = pages.slice(0, 0)
            return pa.table([pages.column("ids"), pages.column("urls"), pa.array([], pa.string()), pa.array([], pa.int64())], names=["ids", "urls", "text", "n_chars"])
        return _texts(pages, frequent, p)

    def to_parts(hosts: DataFrame) -> DataFrame:
        each = hosts.join(F.broadcast(large), "host").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
        return each.drop("salts")

    asked = dealt.sortWithinPartitions("host", "salt").mapInArrow(often, "host string, key long, pages long")
    asked = asked.groupBy("host", "key").agg(F.sum("pages").alias("pages")).groupBy("host").agg(F.sum("pages").alias("pages"), F.collect_list("key").alias("keys"))
    counted = parts.cogroup(to_parts(asked).groupBy("host", "salt")).applyInArrow(count, "host string, key long, n long, pages long")
    enough = F.greatest(F.lit(p.least), F.ceil(F.lit(min(p.inside, p.outside)) * F.col("pages")))
    merged = counted.groupBy("host", "key").agg(F.sum("n").alias("n"), F.max("pages").alias("pages")).filter(F.col("n") >= enough)
    both = F.collect_list(F.struct("key", "n"))
    frequent = merged.groupBy("host").agg(F.max("pages").alias("pages"), both.alias("_k")).select("host", "pages", F.col("_k.key").alias("keys"), F.col("_k.n").alias("counts"))
    out = parts.cogroup(to_parts(frequent).groupBy("host", "salt")).applyInArrow(text, "ids array<long>, urls array<string>, text string, n_chars long")
    out = out.select(F.explode(F.arrays_zip("ids", "urls")).alias("x"), "text", "n_chars")
    return out.select(F.col("x.ids").alias(id_col), F.col("x.urls").alias(url_col), "text", "n_chars")
