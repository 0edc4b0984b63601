"""MinHash near-dedup: universal hash minima, banding, verification, large-star and small-star.

One Arrow pass turns each text into its set's size, a 128-bit key of the set, its band keys
and a fingerprint of its minima.  Equal sets are one class from then on, so copies never
meet in a band.  In each band bucket every class is compared with the bucket's smallest
class only.  Buckets that still hold several components afterwards are dealt out in square
cells of bounded size, and a cell compares its classes of different components within one
task.  So every candidate pair is either tried or already linked; a large group of copies
costs a star, and a large group of lookalikes makes no row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variorum.llm import sieve, store, words


@dataclass(frozen=True)
class MinHash:
    """n-word shingles, similarity in percent, and bands x rows universal hashes.

    A pair of similarity s shares a bucket with probability 1-(1-s**rows)**bands: at 0.8
    all but three in a million.  `slack` is how far the estimate from the minima may lie
    under the threshold before a pair is dismissed: over six standard deviations.
    `cell` is about how many classes of a bucket make one side of a cell.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    slack: float = 0.2
    seed: int = 7
    cell: int = 1024

    @property
    def size(self) -> int:
        return self.bands * self.rows


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct n-word shingles, text after text, sorted; and where each text's begin."""
    w = words.cut(texts, lower=True)
    h = w.hash()
    count = np.diff(w.first)
    many = np.where(count >= n, count - n + 1, np.minimum(count, 1))  # fewer words: the whole sequence as one
    text = np.repeat(np.arange(len(many)), many)
    at = np.concatenate([[0], np.cumsum(many)])
    start = w.first[:-1][text] + np.arange(at[-1]) - at[:-1][text]
    end = start + np.minimum(n, count[text])
    value = words.spans_hash(h, start, end, words.BASES[1])
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[new], text[new]
    return value, np.searchsorted(text, np.arange(len(many) + 1))


def _minima(value: np.ndarray, first: np.ndarray, p: MinHash) -> np.ndarray:
    """Minima of every universal hash over each non-empty set: texts x hashes."""
    rng = np.random.default_rng(p.seed)
    factor = rng.integers(0, 1 << 64, p.size, np.uint64) | np.uint64(1)
    shift = rng.integers(0, 1 << 64, p.size, np.uint64)
    out = np.empty((p.size, len(first)), np.uint32)
    for i in range(p.size):
        out[i] = np.minimum.reduceat(((value * factor[i] + shift[i]) >> np.uint64(32)).astype(np.uint32), first)
    return out.T


def signatures(docs: DataFrame, id_col: str, text_col: str, p: MinHash) -> DataFrame:
    """id, n (set size), ka, kb (key of the set), bands (bucket keys), fp (a byte of each minimum); none for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            value, at = shingle_sets(batch.column(1), p.shingle)
            n = np.diff(at)
            full = n > 0
            keys = [np.zeros(len(n), np.int64) for _ in range(2)]
            bands, fp = [None] * len(n), [None] * len(n)
            if full.any():
                first = at[:-1][full]
                for k, salt in zip(keys, words.BASES, strict=True):
                    k[full] = np.add.reduceat(words.mix(value + np.uint64(salt)), first).view(np.int64)
                minima = _minima(value, first, p)
                key = np.empty((len(minima), p.bands), np.uint64)
                for b in range(p.bands):
                    h = np.full(len(minima), b + 1, np.uint64)
                    for r in range(p.rows):
                        h = words.mix(h * np.uint64(words.BASES[0]) + minima[:, b * p.rows + r])
                    key[:, b] = h
                marks = minima.astype(np.uint8)
                for i, k, row in zip(np.flatnonzero(full), key.view(np.int64), marks, strict=True):
                    bands[i], fp[i] = k, row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n.astype(np.int64)), *(pa.array(k, mask=~full) for k in keys), pa.array(bands, pa.list_(pa.int64())), pa.array(fp, pa.binary())],
                names=["id", "n", "ka", "kb", "bands", "fp"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, n long, ka long, kb long, bands array<long>, fp binary")


def _close(n_a: Column, n_b: Column, p: MinHash) -> Column:
    """Sizes alone allow the similarity."""
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * p.percent


def _alike(pairs: DataFrame, classes: DataFrame, p: MinHash) -> DataFrame:
    """Pairs a, b whose sizes and minima allow the similarity."""
    sides = [classes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("fp").alias(f"f_{x}")) for x in "ab"]
    near = pairs.join(sides[0], "a").join(sides[1], "b").filter(_close(F.col("n_a"), F.col("n_b"), p))
    least = p.percent / 100 - p.slack

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, p.size) for i in (2, 3))
                yield batch.select(["a", "b"]).filter(pa.array((a == b).mean(axis=1) >= least))

    return near.select("a", "b", "f_a", "f_b").mapInArrow(run, "a long, b long")


def _sets(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str, p: MinHash) -> DataFrame:
    """id, members: the full sets of the given ids, built anew from their texts."""

    wanted = store.cut(ids.select("id").distinct())
    some = sieve.made(wanted, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(some.open(batch.column(2).to_numpy(zero_copy_only=False))))
            for part in words.slices(iter([batch]), "text"):
                value, at = shingle_sets(part.column(1), p.shingle)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([value[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["id", "members"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("at", some.place(F.col("id")))
    return rows.mapInArrow(run, "id long, members binary").join(wanted, "id", "left_semi").dropDuplicates(["id"])


def _confirm(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, p: MinHash) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity."""

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= p.percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    members = store.cut(_sets(pairs.select(F.explode(F.array("a", "b")).alias("id")), docs, id_col, text_col, p))
    sides = [members.select(F.col("id").alias(x), F.col("members").alias(f"m_{x}")) for x in "ab"]
    joined = pairs.join(sides[0], "a").join(sides[1], "b")
    return joined.select("a", "b", "m_a", "m_b").mapInArrow(same, "a long, b long")


CELL = ["key", "lo", "hi"]


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one cell after another; rows come sorted by cell."""
    held: list[pa.Table] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in CELL])
        cuts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1), batch.num_rows]
        table = pa.Table.from_batches([batch])
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            name = tuple(at[:, i])
            if held and name != now:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(i, j - i))
            now = name
    if held:
        yield pa.concat_tables(held)


def _facing(cell: pa.Table, p: MinHash) -> np.ndarray:
    """Which rows of a cell may be linked by size and are not linked yet; each pair once, in one cell."""
    n, component, block = (cell.column(c).to_numpy() for c in ("n", "component", "block"))
    lo, hi = cell.column("lo")[0].as_py(), cell.column("hi")[0].as_py()
    may = (100 * np.minimum.outer(n, n) >= p.percent * np.maximum.outer(n, n)) & np.not_equal.outer(component, component)
    if lo != hi:
        may &= np.not_equal.outer(block, block)
    return np.triu(may, 1)


def _lookalikes(batches: Iterator[pa.RecordBatch], p: MinHash) -> Iterator[pa.RecordBatch]:
    """Rows of a cell that some other row resembles by the minima."""
    least = (p.percent / 100 - p.slack) * p.size
    for cell in _by_cell(batches):
        may = _facing(cell, p)
        if may.any():
            fp = np.frombuffer(b"".join(cell.column("fp").to_pylist()), np.uint8).reshape(-1, p.size)
            near = np.zeros(len(fp), bool)
            for i in np.flatnonzero(may.any(axis=1)):
                others = np.flatnonzero(may[i])
                hit = others[(fp[others] == fp[i]).sum(axis=1) >= least]
                near[hit] = True
                near[i] |= len(hit) > 0
            if near.any():
                yield from cell.drop_columns(["fp"]).filter(pa.array(near)).combine_chunks().to_batches()


def _linked(batches: Iterator[pa.RecordBatch], p: MinHash) -> Iterator[pa.RecordBatch]:
    """Links a, b of a cell by the full sets, each a bit mask over the cell's shared shingles."""
    for cell in _by_cell(batches):
        may = _facing(cell, p)
        ids, n = cell.column("id").to_pylist(), cell.column("n").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in cell.column("members").to_pylist()]
        value, count = np.unique(np.concatenate(sets), return_counts=True)
        value = value[count > 1]
        masks = []
        for x in sets:
            bits = np.zeros(len(value), np.uint8)
            bits[np.searchsorted(value, np.intersect1d(x, value, assume_unique=True))] = 1
            masks.append(int.from_bytes(np.packbits(bits).tobytes(), "big"))
        out = []
        for i, j in zip(*np.nonzero(may), strict=True):
            both = (masks[i] & masks[j]).bit_count()
            if 100 * both >= p.percent * (n[i] + n[j] - both):
                out.append((ids[i], ids[j]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["a", "b"])


def _rest(shared: DataFrame, found: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, p: MinHash) -> DataFrame:
    """Links a, b between different components that meet in a bucket."""
    placed = shared.select("key", "id").join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    size = placed.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("many")).filter("least <> most")
    sides = F.ceil(F.col("many") / F.lit(float(p.cell))).cast("long")
    rows = placed.join(size.select("key", sides.alias("sides")), "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("sides")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)))
    cells = store.cut(rows.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "component"))
    near = cells.join(classes.select("id", "n", "fp"), "id").select(*CELL, "block", "id", "component", "n", "fp")
    near = near.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(lambda b: _lookalikes(b, p), "key long, lo long, hi long, block long, id long, component long, n long")
    near = store.cut(near)
    sets = store.cut(_sets(near, docs, id_col, text_col, p))
    full = near.join(sets, "id").repartition(*CELL).sortWithinPartitions(*CELL)
    return full.mapInArrow(lambda b: _linked(b, p), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, component (smallest reachable id) of every id in an edge (a, b), by alternating large-star and small-star."""
    both = lambda e: e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    edges = store.cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        # large-star: neighbours larger than u go to the smallest of u and its neighbours
        ring = both(edges)
        low = ring.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = ring.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        # small-star: u and its smaller neighbours go to the smallest of these
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        edges = store.cut(small.distinct())
    return edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")).union(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: MinHash | None = None) -> DataFrame:
    """id_col, n_shingles, component_id, kept: one row per document with an id.

    Words are lower-cased in A-Z.  A text of fewer words than a shingle is one shingle; null,
    empty or blank text has an empty set, links with nothing and is kept.  Rows that repeat an
    id give one row each; a null id has no place in the order and is left out.  Other columns
    of `docs` are not read.  The smallest id of each component is kept.
    """
    p = params or MinHash()
    docs = docs.filter(F.col(id_col).isNotNull())
    signed = store.cut(signatures(docs, id_col, text_col, p))
    full = signed.filter("n > 0")
    # aggregates are cut off before they are joined, so that Spark may split a large class or bucket
    classes = store.cut(full.groupBy("ka", "kb").agg(F.min("id").alias("rep")))
    # the row of a class's smallest id stands for it
    # rows that share an id but not the text stand with that of the least key
    one = full.join(classes.select(F.col("rep").alias("id")), "id", "left_semi").groupBy("id").agg(F.min_by(F.struct("n", "bands", "fp"), F.struct("ka", "kb")).alias("x"))
    one = store.cut(one.select("id", "x.n", "x.bands", "x.fp"))
    rows = one.select(F.explode("bands").alias("key"), "id")
    heads = store.cut(rows.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("many")).filter("many > 1").select("key", "head"))
    shared = store.cut(rows.join(heads, "key"))
    stars = store.cut(_alike(shared.filter("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct(), one, p))
    links = store.cut(_confirm(stars, docs, id_col, text_col, p))
    found = store.cut(components(links))
    more = store.cut(_rest(shared, found, one, docs, id_col, text_col, p))
    if not more.isEmpty():
        found = store.cut(components(links.union(more)))
    members = full.join(classes, ["ka", "kb"]).join(found.withColumnRenamed("id", "rep"), "rep", "left").select("id", "n", F.coalesce("component", "rep").alias("component"))
    out = members.union(signed.filter("n = 0").select("id", "n", F.col("id").alias("component")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))
