"""Benchmark decontamination: latent semantic retrieval, then word-order and answer checks.

Benchmark items are cut into passages and weighted by TF-IDF, with document frequencies of
the whole corpus.  A randomised SVD, whose products with the passage matrix are Spark jobs,
gives a latent space.  Windows of every document are folded into it and compared with the
passages by cosine; the longest common subsequence with the item, and with its answer,
decides.  Items are taken in blocks of bounded size, all documents against each block.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variorum.llm import store, words


@dataclass(frozen=True)
class Latent:
    """Sizes in words, thresholds as shares.

    `features` hashed terms bound what is broadcast: an idf for each, and `rank` numbers for
    each that occurs in a block of `block_passages`.  A window is a candidate where its
    projection on a passage is `contained` of the passage or more: the cosine, scaled by both
    lengths since a passage may fill only part of a window.  Windows are two steps long.  An item is found where `common`
    of its words appear in order, or `answered` of them with `answer` of its last sentence.
    """

    passage: int = 32
    step: int = 24
    features: int = 1 << 18
    rank: int = 128
    oversample: int = 8
    power: int = 1
    block_passages: int = 2048
    contained: float = 0.45
    common: float = 0.8
    answered: float = 0.6
    answer: float = 0.8
    seed: int = 5


# features whose counts travel together
PART = 1024


def _feature(h: np.ndarray, p: Latent) -> np.ndarray:
    return (h >> np.uint64(20)).astype(np.int64) & (p.features - 1)


def passage_counts(docs: DataFrame, text_col: str, p: Latent) -> DataFrame:
    """part, df: in how many step-long passages of the texts the terms of each part of the features occur; part -1 counts the passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(p.features + 1, np.int64)
        for batch in words.slices(batches, "text"):
            w = words.cut(batch.column(0), lower=True)
            count = np.diff(w.first)
            within = np.arange(len(w.start)) - np.repeat(w.first[:-1], count)
            base = np.concatenate([[0], np.cumsum(-(-count // p.step))])
            key = (np.repeat(base[:-1], count) + within // p.step) * p.features + _feature(w.hash(), p)
            key.sort()
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            total[:-1] += np.bincount(key[new] & (p.features - 1), minlength=p.features)
            total[-1] += base[-1]
        parts = total[:-1].reshape(-1, PART)
        some = np.flatnonzero(parts.any(axis=1))
        names, rows = [*some.tolist(), -1], [*parts[some], total[-1:]]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(rows, pa.list_(pa.int64()))], names=["part", "df"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "part int, df array<long>")
    return rows.repartition("part").mapInArrow(functools.partial(_summed, names=("part", "df"), kind=pa.int64()), "part int, df array<long>")


def _summed(batches: Iterator[pa.RecordBatch], names: tuple[str, str], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Arrays of one length added up by key; the keys of a partition are as few as the sizes of the space allow."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            total[k] = total.get(k, 0) + x.values.to_numpy()
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array(list(total.values()), pa.list_(kind))], names=names)


def idf_table(counts: DataFrame, p: Latent) -> np.ndarray:
    """Inverse document frequency of every feature; `features` numbers, whatever the corpus."""
    df = np.zeros(p.features)
    n = 0
    for row in counts.toArrow().to_pylist():
        if row["part"] < 0:
            n = row["df"][0]
        else:
            df[row["part"] * PART : (row["part"] + 1) * PART] = row["df"]
    return np.log((n + 1) / (df + 0.5)).clip(0.05).astype(np.float32)


def _passages(texts: pa.Array, p: Latent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of the texts, where each passage begins, and whose it is; passages of an item are even in size."""
    w = words.cut(texts, lower=True)
    count = np.diff(w.first)
    parts = -(-count // p.passage)
    owner = np.repeat(np.arange(len(count)), parts)
    k = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(parts)[:-1]]), parts)
    start = w.first[:-1][owner] + k * count[owner] // parts[owner]
    return w.hash(), np.append(start, len(w.start)), owner


def _terms(f: np.ndarray, at: np.ndarray, p: Latent) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of each passage, and where each passage's begin: a term counts once, however often it is said."""
    key = np.unique(np.repeat(np.arange(len(at) - 1), np.diff(at)) * p.features + f)
    return key & (p.features - 1), np.searchsorted(key, np.arange(len(at)) * p.features)


def _project(f: np.ndarray, at: np.ndarray, idf: np.ndarray, local: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Rows of TF-IDF matrix x basis, for passages of the terms f that begin at `at`."""
    where = local[f]
    x = basis[where] * (idf[f] * (where >= 0))[:, None]
    return np.add.reduceat(x, at[:-1], axis=0) if len(at) > 1 else np.zeros((0, basis.shape[1]), np.float32)


def _sketch(items: DataFrame, idf: np.ndarray, local: np.ndarray, basis: np.ndarray, p: Latent) -> np.ndarray:
    """A'(A basis) for the passage matrix A of the items, summed by Spark over their partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros_like(basis)
        for batch in words.slices(batches, "text"):
            h, at, _ = _passages(batch.column(1), p)
            if len(h):
                f, at = _terms(_feature(h, p), at, p)
                z = _project(f, at, idf, local, basis)
                order = np.argsort(local[f], kind="stable")
                rows, begin = np.unique(local[f][order], return_index=True)
                terms = z[np.repeat(np.arange(len(z)), np.diff(at))[order]] * idf[f[order]][:, None]
                out[rows] += np.add.reduceat(terms, begin, axis=0)
        some = np.flatnonzero(out.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(list(out[some].astype(np.float64)), pa.list_(pa.float64()))], names=["row", "x"])

    # the sum of a term lies in one partition; it is as many numbers as the space has dimensions
    table = items.mapInArrow(run, "row int, x array<double>").repartition("row")
    table = table.mapInArrow(functools.partial(_summed, names=("row", "x"), kind=pa.float64()), "row int, x array<double>").toArrow()
    out = np.zeros(basis.shape, np.float64)
    if table.num_rows:
        out[table.column("row").to_numpy()] = np.stack(table.column("x").to_numpy())
    return out


@dataclass
class Space:
    """The latent space of one block of items: passages in it, and the items' words for the checks."""

    local: np.ndarray
    basis: np.ndarray
    latent: np.ndarray
    square: np.ndarray
    owner: np.ndarray
    ids: list
    hashes: list
    counts: list
    answers: list


def _answer(text: str, n: int) -> int:
    """How many of the item's last words are its answer: the last sentence, or a quarter if there is but one."""
    body = text.rstrip(" \t\n\x0b\x0c\r.!?")
    cut = max((body.rfind(c) for c in ".!?\n"), default=-1)
    tail = len(text[cut + 1 :].encode().split()) if cut >= 0 else 0
    return tail if 0 < tail < n else max(1, n // 4)


def fit(items: DataFrame, idf: np.ndarray, p: Latent) -> Space | None:
    """The latent space of the items (id, text) by a randomised SVD; None if they hold no word."""
    table = items.toArrow()  # one block: at most block_passages items
    texts = table.column("text").combine_chunks()
    texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
    h, at, owner = _passages(texts, p)
    if not len(h):
        return None
    f, term_at = _terms(_feature(h, p), at, p)
    known = np.unique(f)
    local = np.full(p.features, -1, np.int32)
    local[known] = np.arange(len(known))
    width = min(p.rank + p.oversample, len(owner), len(known))
    y = np.random.default_rng(p.seed).standard_normal((len(known), width))
    for _ in range(1 + p.power):
        y = np.linalg.qr(_sketch(items, idf, local, np.linalg.qr(y)[0].astype(np.float32), p))[0]
    b = _project(f, term_at, idf, local, y.astype(np.float32)).astype(np.float64)
    _, _, vt = np.linalg.svd(b, full_matrices=False)
    turn = vt[: p.rank].T
    first = np.concatenate([[0], np.cumsum(np.bincount(owner[np.repeat(np.arange(len(owner)), np.diff(at))], minlength=len(texts)))])
    square = np.add.reduceat(idf[f].astype(np.float64) ** 2, term_at[:-1])
    hashes = [h[i:j] for i, j in zip(first[:-1], first[1:], strict=True)]
    answers = [_answer(t or "", len(x)) for t, x in zip(texts.to_pylist(), hashes, strict=True)]
    return Space(local, (y @ turn).astype(np.float32), (b @ turn).astype(np.float32), square.astype(np.float32), owner, table.column("id").to_pylist(), hashes, [Counter(x.tolist()) for x in hashes], answers)


def common_length(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    at: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        if m := at.get(x):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def _folded(slots: np.ndarray, weighted: np.ndarray) -> np.ndarray:
    """Latent vectors of blocks of terms; row 0 of `weighted` is no term, and a term counts once in a block."""
    slots.sort(axis=1)
    slots[:, 1:][slots[:, 1:] == slots[:, :-1]] = 0
    z = weighted[slots[:, 0]]
    more = np.empty_like(z)
    for j in range(1, slots.shape[1]):
        z += np.take(weighted, slots[:, j], axis=0, out=more, mode="clip")
    return z


def _search(batches: Iterator[pa.RecordBatch], s: Space, idf: np.ndarray, p: Latent) -> Iterator[pa.RecordBatch]:
    weighted = np.concatenate([np.zeros((1, s.basis.shape[1]), np.float32), s.basis * idf[s.local >= 0][:, None]])
    need = p.contained * (s.latent**2).sum(axis=1)
    for batch in words.slices(batches, "text"):
        w = words.cut(batch.column(1), lower=True)
        h = w.hash()
        f = _feature(h, p)
        count = np.diff(w.first)
        many = -(-count // p.step)
        first = np.concatenate([[0], np.cumsum(many)])
        text = np.repeat(np.arange(len(many)), many)
        slots = np.zeros((first[-1], p.step), np.int32)
        within = np.arange(len(f)) - np.repeat(w.first[:-1], count)
        slots[np.repeat(first[:-1], count) + within // p.step, within % p.step] = s.local[f] + 1
        out: list[tuple] = []
        tried: dict[tuple[int, int], list[tuple[float, float, int, int]]] = {}
        for lot in range(0, len(slots), 2048):
            z = _folded(slots[lot : lot + 2049], weighted)  # one more, for the last pair
            t = text[lot : lot + 2049]
            pair = z.copy()
            pair[:-1][t[1:] == t[:-1]] += z[1:][t[1:] == t[:-1]]
            score = pair[:2048] @ s.latent.T
            for i, j in zip(*np.nonzero(score >= need), strict=True):
                doc = int(t[i])
                lo = int(w.first[doc] + (lot + i - first[doc]) * p.step)
                hi = min(lo + 2 * p.step, int(w.first[doc + 1]))
                size = float(np.sqrt((idf[f[lo:hi]].astype(np.float64) ** 2).sum() * s.square[j]))
                tried.setdefault((doc, int(s.owner[j])), []).append((float(score[i, j] / need[j]), float(score[i, j]) / size, lo, hi))
        for (doc, item), found in tried.items():
            item_words, tail = s.hashes[item], s.answers[item]
            n = len(item_words)
            for _, cosine, lo, hi in sorted(found, reverse=True):
                region = h[max(w.first[doc], lo - n) : min(w.first[doc + 1], hi + n)]
                there = s.counts[item].keys() & region.tolist()
                if sum(s.counts[item][x] for x in there) < p.answered * n:
                    continue  # too few of its words are there in any order
                common = common_length(item_words, region)
                said = common_length(item_words[n - tail :], region)
                if common >= p.common * n or (common >= p.answered * n and said >= p.answer * tail):
                    out.append((doc, s.ids[item], cosine, common, n, said, tail))
                    break
        if out:
            rows, *rest = zip(*out, strict=True)
            kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), *(pa.array(x, t) for x, t in zip(rest, kinds, strict=True))],
                names=["doc", "item", "cosine", "common", "item_words", "answered", "answer_words"],
            )


def contaminated(docs: DataFrame, benchmark: DataFrame, params: Latent | None = None, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """id_col, item_col, cosine, common, item_words, answered, answer_words: documents that hold a benchmark item.

    Null or blank texts on either side hold nothing and are found nowhere.  A repeated
    document row gives its rows again, a repeated item row is one item.  Other columns are
    not read.  An empty benchmark or corpus gives no rows.
    """
    p = params or Latent()
    items = benchmark.filter(F.col(item_col).isNotNull() & F.col(item_text).isNotNull())
    items = items.groupBy(F.col(item_col).cast("long").alias("id"), F.col(item_text).cast("string").alias("text")).agg(F.ceil(F.size(F.split(F.first(item_text), r"\s+")) / F.lit(float(p.passage))).alias("parts"))
    items = store.cut(items)
    parts = items.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    schema = "doc long, item long, cosine double, common long, item_words long, answered long, answer_words long"
    out = docs.sparkSession.createDataFrame([], schema)
    if parts:
        idf = idf_table(passage_counts(docs, text_col, p), p)
        blocks = max(1, -(-2 * parts // p.block_passages)) if parts > p.block_passages else 1
        for b in range(blocks):
            space = fit(items.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).select("id", "text"), idf, p)
            if space is not None:
                out = out.union(rows.mapInArrow(functools.partial(_search, s=space, idf=idf, p=p), schema))
    return out.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "cosine", "common", "item_words", "answered", "answer_words")
