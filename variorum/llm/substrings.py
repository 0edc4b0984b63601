"""Substring dedup by relative Lempel-Ziv parsing against an index of every reference block.

A reference block is the run of windows of a document that choose the same anchor (the
k-word group of least hash in the window), with all the words they cover.  Blocks are cut by
content alone, so shared text is cut alike wherever it stands.  The index holds, for every
block, the first document that has it; a document is factored greedily into the longest runs
of blocks that an earlier document has, and these runs are duplicate spans.  At factor
boundaries, where blocks share an anchor but not all their words, single windows are looked
up instead.  The result is exact: a word goes if and only if some window over it starts in a
document of smaller id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variorum.llm import sieve, store, words


@dataclass(frozen=True)
class Parse:
    """Words of a window (the shortest factor), and of an anchor."""

    window: int = 50
    anchor: int = 12


def _hashes(w: words.Words) -> tuple[np.ndarray, np.ndarray]:
    return w.hash(words.BASES[0]), w.hash(words.BASES[1])


def _double(h: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each run of words."""
    return words.spans_hash(h[0], start, end, words.BASES[1]), words.spans_hash(h[1], start, end, words.BASES[0])


def blocks(docs: DataFrame, id_col: str, text_col: str, p: Parse) -> DataFrame:
    """doc, s, m, anchor, ca, cb: the m windows from word s on share an anchor; ca and cb are the hashes of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            w = words.cut(batch.column(1))
            many = np.maximum(np.diff(w.first) - p.window + 1, 0)
            if not many.any():
                continue
            h = _hashes(w)
            text = np.repeat(np.arange(len(many)), many)
            base = np.concatenate([[0], np.cumsum(many)])
            start = w.first[:-1][text] + np.arange(base[-1]) - base[:-1][text]
            group = np.arange(len(h[0]) - p.anchor + 1)
            value = words.spans_hash(h[0], group, group + p.anchor, words.BASES[1])
            wide = np.lib.stride_tricks.sliding_window_view(value, p.window - p.anchor + 1)
            at = np.empty(len(start), np.int64)
            for i in range(0, len(start), 1 << 15):
                part = start[i : i + (1 << 15)]
                at[i : i + (1 << 15)] = part + wide[part].argmin(axis=1)
            new = np.ones(len(start), bool)
            new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
            lead = np.flatnonzero(new)
            m = np.diff(np.append(lead, len(start)))
            s = start[lead]
            ca, cb = _double(h, s, s + m - 1 + p.window)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(text[lead])),
                    pa.array((s - w.first[:-1][text[lead]]).astype(np.int32)),
                    pa.array(m.astype(np.int32)),
                    *(pa.array(x.view(np.int64)) for x in (value[at[lead]], ca, cb)),
                ],
                names=["doc", "s", "m", "anchor", "ca", "cb"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).filter("doc is not null")
    return rows.mapInArrow(run, "doc long, s int, m int, anchor long, ca long, cb long")


def _windows(batches: Iterator[pa.RecordBatch], p: Parse) -> Iterator[pa.RecordBatch]:
    """doc, s, wa, wb: the hashes of the listed windows of each text."""
    for batch in words.slices(batches, "text"):
        w = words.cut(batch.column(1))
        h = _hashes(w)
        runs = batch.column(2)
        row = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(runs).to_numpy())
        flat = runs.flatten()
        s, m = flat.field(0).to_numpy(), flat.field(1).to_numpy()
        each = np.repeat(np.arange(len(s)), m)
        within = s[each] + np.arange(len(each)) - np.repeat(np.cumsum(m) - m, m)
        start = w.first[:-1][row[each]] + within
        wa, wb = _double(h, start, start + p.window)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row[each])), pa.array(within.astype(np.int32)), pa.array(wa.view(np.int64)), pa.array(wb.view(np.int64))], names=["doc", "s", "wa", "wb"]
        )


def _remaining(batches: Iterator[pa.RecordBatch], p: Parse) -> Iterator[pa.RecordBatch]:
    """The words left of each text when those under the listed windows are gone."""
    for batch in words.slices(batches, "text"):
        w = words.cut(batch.column(1))
        data = w.data.tobytes()
        count, removed, factors, digest, left = [], [], [], [], []
        for i, runs in enumerate(batch.column(2).to_pylist()):
            a, b = int(w.first[i]), int(w.first[i + 1])
            edge = np.zeros(b - a + 1, np.int64)
            for r in runs or ():
                edge[r["s"]] += 1
                edge[r["s"] + r["m"] - 1 + p.window] -= 1
            gone = np.cumsum(edge)[:-1] > 0
            keep = np.flatnonzero(~gone) + a
            text = b" ".join([data[x:y] for x, y in zip(w.start[keep].tolist(), w.end[keep].tolist(), strict=True)])
            count.append(b - a)
            removed.append(b - a - len(keep))
            factors.append(int((np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1).sum()))
            digest.append(hashlib.sha256(text).hexdigest())
            left.append(text.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(count, pa.int64()), pa.array(removed, pa.int64()), pa.array(factors, pa.int64()), pa.array(digest, pa.string()), pa.array(left, pa.string())],
            names=["doc", "n_words", "n_removed", "n_factors", "kept_sha256", "kept_text"],
        )


def _by_doc(runs: DataFrame) -> DataFrame:
    """doc, runs: the runs of windows of each document; no more than it has words."""
    return runs.groupBy("doc").agg(F.collect_list(F.struct("s", "m")).alias("runs"))


def duplicate_runs(docs: DataFrame, id_col: str, text_col: str, p: Parse) -> DataFrame:
    """doc, s, m: the m windows from word s on also start in a document of smaller id."""
    every = blocks(docs, id_col, text_col, p)
    # anchors that two documents have; no other window can be shared
    # aggregates are cut off before they are joined, so that Spark may split a hot anchor's other side
    shared = store.cut(every.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo < hi").select("anchor"))
    met = store.cut(every.join(shared, "anchor"))
    index = met.groupBy("anchor", "ca", "cb").agg(F.min("doc").alias("owner"))
    # the anchor has several blocks: windows of one may lie in another
    mixed = index.groupBy("anchor").agg(F.min(F.struct("ca", "cb")).alias("x"), F.max(F.struct("ca", "cb")).alias("y")).filter("x <> y").select("anchor", F.lit(True).alias("mixed"))
    index = store.cut(index.join(mixed, "anchor", "left"))
    placed = store.cut(met.join(index, ["anchor", "ca", "cb"]).select("doc", "s", "m", "owner", F.coalesce("mixed", F.lit(False)).alias("mixed")).filter("mixed or owner < doc"))
    whole = placed.filter("owner < doc").select("doc", "s", "m")
    edge = _by_doc(placed.filter("mixed and owner = doc").select("doc", "s", "m"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    edge = store.cut(edge)
    some = sieve.made(edge, "doc")

    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(some.open(batch.column(2).to_numpy(zero_copy_only=False)))).select(["doc", "text"])

    texts = texts.filter("doc is not null").withColumn("at", some.place(F.col("doc"))).mapInArrow(sifted, "doc long, text string")
    single = store.cut(texts.join(edge, "doc").mapInArrow(lambda b: _windows(b, p), "doc long, s int, wa long, wb long"))
    first = store.cut(single.groupBy("wa", "wb").agg(F.min("doc").alias("owner"), F.max("doc").alias("last")).filter("owner < last").select("wa", "wb", "owner"))
    found = single.join(first, ["wa", "wb"]).filter("owner < doc").select("doc", "s", F.lit(1).alias("m"))
    return whole.union(found)


def deduplicated(docs: DataFrame, params: Parse | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_words, n_removed, n_factors, kept_sha256, kept_text: one row per row of `docs`.

    A null or blank text has no words; texts shorter than a window keep all.  A row without an
    id keeps all its words and takes none from others.  Rows that repeat an id must repeat the
    text; each gives its row.  Other columns are not read.
    """
    p = params or Parse()
    runs = store.cut(_by_doc(duplicate_runs(docs, id_col, text_col, p)))
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    out = texts.join(runs, "doc", "left").mapInArrow(lambda b: _remaining(b, p), "doc long, n_words long, n_removed long, n_factors long, kept_sha256 string, kept_text string")
    return out.withColumnRenamed("doc", id_col)
