"""Phrase collocation mining: word-id sequences counted in a HAT-trie, level by level.

A task keeps the sequences of one length in a trie on word ids whose leaves are containers of
sequences and counts.  A container that grows too large bursts into children by the next
word; when the whole trie grows too large, its largest subtrees leave as sorted runs.  Most
sequences are rare, so a level is counted twice.  First the runs are packed to the hashes of
their sequences, some three bytes each, and merged per prefix partition, that is by the first
two words; a hash whose sum stays under the threshold holds no candidate.  Then the sequences
whose hash reached it are counted in full.  A phrase can only be as frequent as each phrase
inside it, so level k counts only sequences whose two parts of k-1 words reached the threshold.
Bitmaps of bounded size tell the tasks which; they may let others through, and the full counts
decide.  So the counts of all phrases that reach the threshold are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from variorum.llm import sieve, store, words

_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, *range(0x0A, 0x0E), *b".,;:!?"]] = True
_BREAK = _GAP.copy()
_BREAK[[0x20, 0x09]] = False
NO_LANG = "und"


@dataclass(frozen=True)
class Mining:
    """Words of the longest phrase, occurrences of a candidate, rows of each language's report.

    `burst` entries make a container burst, `most` make the trie send out subtrees; `batch`
    occurrences are reduced before they enter it.  `share` is about how many occurrences one
    prefix partition merges.
    """

    longest: int = 5
    least: int = 100
    report: int = 2000
    burst: int = 1 << 15
    most: int = 1 << 20
    batch: int = 1 << 19
    fan: int = 16
    share: int = 1 << 20


def _fold(columns: list[np.ndarray]) -> np.ndarray:
    """One 64-bit key of some columns of ids, row by row."""
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = words.mix(h * np.uint64(words.BASES[0]) + c)
    return h


#: bits of a sequence's hash, the first of which are its prefix partition
KEY = 44


def _hash(columns: list[np.ndarray], bits: int) -> np.ndarray:
    """A hash of each row: `bits` bits of the language and the first two words, the rest of all words."""
    h = prefix = np.zeros(len(columns[0]), np.uint64)
    for i, c in enumerate(columns):
        h = words.mix(h * np.uint64(words.BASES[0]) + c)
        prefix = h if i < 3 else prefix
    return (prefix >> np.uint64(64 - bits)) << np.uint64(KEY - bits) | words.mix(h) >> np.uint64(64 - KEY + bits)


def _summed(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Like rows with the sum of their counts, in order of their key (unlike rows of one key may leave several; Spark's sum is exact)."""
    if not len(n):
        return columns, n
    order = np.argsort(_fold(columns))
    columns = [c[order] for c in columns]
    new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.concatenate([[0], np.flatnonzero(new) + 1])
    return [c[at] for c in columns], np.add.reduceat(n[order], at)


Run = tuple[list[np.ndarray], np.ndarray]


class HatTrie:
    """Counts of id sequences: containers under a shallow trie on the sequence's words.

    Columns are the language and the words.  A path is a digit of each of the first words.
    """

    def __init__(self, k: int, p: Mining):
        self.k, self.p = k, p
        self.inner: set[tuple[int, ...]] = {()}
        self.leaves: dict[tuple[int, ...], list[Run]] = {}
        self.limit: dict[tuple[int, ...], int] = {}
        self.size: dict[tuple[int, ...], int] = {}
        self.waiting: list[list[np.ndarray]] = []
        self.held = 0

    def add(self, columns: list[np.ndarray]) -> Iterator[Run]:
        """Count the rows of the columns; what must leave for it comes back."""
        self.waiting.append(columns)
        self.held += len(columns[0])
        if self.held >= self.p.batch:
            self._settle()
            if sum(self.size.values()) > self.p.most:
                yield from self.spill(self.p.most // 2)

    def _settle(self) -> None:
        if self.held:
            columns = [np.concatenate(c) for c in zip(*self.waiting, strict=True)]
            self._push((), *_summed(columns, np.ones(self.held, np.int64)))
        self.waiting, self.held = [], 0

    def _push(self, path: tuple[int, ...], columns: list[np.ndarray], n: np.ndarray) -> None:
        if path in self.inner:
            digit = (columns[1 + len(path)] % np.uint64(self.p.fan)).astype(np.int64)
            order = np.argsort(digit, kind="stable")
            cuts = np.searchsorted(digit[order], np.arange(self.p.fan + 1))
            for d, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if j > i:
                    part = order[i:j]
                    self._push((*path, d), [c[part] for c in columns], n[part])
            return
        self.leaves.setdefault(path, []).append((columns, n))
        self.size[path] = self.size.get(path, 0) + len(n)
        if self.size[path] > self.limit.get(path, self.p.burst):
            columns, n = self._container(path)
            if len(path) < self.k and len(n) > self.p.burst // 2:
                self.inner.add(path)
                del self.leaves[path], self.size[path]
                self._push(path, columns, n)
            else:
                self.leaves[path], self.size[path] = [(columns, n)], len(n)
                self.limit[path] = max(self.p.burst, 2 * len(n))

    def _container(self, path: tuple[int, ...]) -> Run:
        runs = self.leaves[path]
        return runs[0] if len(runs) == 1 else _summed([np.concatenate(c) for c in zip(*(r[0] for r in runs), strict=True)], np.concatenate([r[1] for r in runs]))

    def spill(self, most: int = 0) -> Iterator[Run]:
        """Subtrees under the root, largest first, as sorted runs, until at most `most` entries are left."""
        if not most:
            self._settle()
        trees: dict[int, int] = {}
        for path, n in self.size.items():
            trees[path[0]] = trees.get(path[0], 0) + n
        left = sum(trees.values())
        for root in sorted(trees, key=lambda d: (-trees[d], d)):
            if left <= most:
                return
            left -= trees[root]
            for path in sorted(x for x in self.leaves if x[0] == root):
                yield self._container(path)
                del self.leaves[path], self.size[path]


def _cut(batch: pa.RecordBatch, seed: int) -> tuple[words.Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words of the texts, their ids, their languages' hashes, and a number that changes with the piece."""
    w = words.cut(batch.column(2), lower=True, gap=_GAP)
    text = np.repeat(np.arange(batch.num_rows), np.diff(w.first))
    piece = np.cumsum(_BREAK[w.data])[w.start] + text
    return w, w.hash(words.BASES[0] + 2 * seed), batch.column(1).to_numpy().view(np.uint64)[text], piece


def _names(batch: pa.RecordBatch) -> dict[int, str]:
    return dict(zip(batch.column(1).to_numpy().view(np.uint64).tolist(), batch.column(0).to_pylist(), strict=True))


def _sequences(batch: pa.RecordBatch, k: int, seed: int) -> tuple[words.Words, list[np.ndarray], np.ndarray]:
    """The words, the columns of every k words in a row, and where these lie within one piece."""
    w, ids, lang, piece = _cut(batch, seed)
    n = max(len(ids) - k + 1, 0)
    return w, [lang[:n], *(ids[j : j + n] for j in range(k))], piece[k - 1 :][:n] == piece[:n]


def _packed(columns: list[np.ndarray], n: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    """Partition and sorted run of hashes and counts: differences and counts by byte planes, compressed."""
    key = _hash(columns, bits)
    order = np.argsort(key)
    key, n = key[order], n[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    at = np.flatnonzero(new)
    key, n = key[at], np.add.reduceat(n, at)
    part = (key >> np.uint64(KEY - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist()
    pack = zstandard.ZstdCompressor(level=1).compress
    for i, j in zip(cuts, [*cuts[1:], len(key)], strict=True):
        step = np.diff(key[i:j], prepend=np.uint64(0))
        planes = np.concatenate([x.astype("<u8").view(np.uint8).reshape(-1, 8).T.reshape(-1) for x in (step, n[i:j].astype(np.uint64))])
        yield int(part[i]), pack(planes.tobytes())


def _unpacked(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(run), np.uint8).reshape(2, 8, -1)
    step, n = (np.ascontiguousarray(x.T).view("<u8").reshape(-1) for x in planes)
    return np.cumsum(step, dtype=np.uint64), n


_RUNS = "part int, run binary, lang string, n long"


def _rough(batches: Iterator[pa.RecordBatch], k: int, known: sieve.Sieve | None, bits: tuple[int, int], seed: int, p: Mining) -> Iterator[pa.RecordBatch]:
    """Packed runs of the sequences of k words whose two parts may be frequent; for k of 1, every language's words too.

    `bits` are the prefix bits of the parts' hashes and of their own.
    """
    trie = HatTrie(k, p)
    names: dict[int, str] = {}
    total: dict[int, int] = {}

    def sent(runs: list[Run]) -> Iterator[pa.RecordBatch]:
        if runs:
            columns = [np.concatenate(c) for c in zip(*(r[0] for r in runs), strict=True)]
            part, run = zip(*_packed(columns, np.concatenate([r[1] for r in runs]), bits[1]), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(run, pa.binary()), pa.nulls(len(part), pa.string()), pa.nulls(len(part), pa.int64())], names=["part", "run", "lang", "n"])

    for batch in words.slices(batches, "text"):
        _, columns, ok = _sequences(batch, k, seed)
        if not len(ok):
            continue
        if k == 1:
            names |= _names(batch)
            for x, n in zip(*np.unique(columns[0], return_counts=True), strict=True):
                total[int(x)] = total.get(int(x), 0) + int(n)
        else:
            lang, *ids = columns
            # both parts of all sequences: the first of each, and the last one's second
            first = [np.append(c, c[-1:]) for c in (lang, *ids[:-1])]
            for c, x in zip(first[1:], ids[1:], strict=True):
                c[-1] = x[-1]
            may = known.open((_hash(first, bits[0]) & np.uint64(known.bits - 1)).astype(np.int64))
            # the second part is the first of the next sequence, which within a piece has the same language
            ok &= may[:-1] & may[1:]
        at = np.flatnonzero(ok)
        if len(at):
            yield from sent(list(trie.add([c[at] for c in columns])))
    yield from sent(list(trie.spill()))
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(total), pa.int32()), pa.nulls(len(total), pa.binary()), pa.array([names[x] for x in total], pa.string()), pa.array(list(total.values()), pa.int64())],
            names=["part", "run", "lang", "n"],
        )


def _merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The hashes of each partition whose counts reach the threshold together; rows come by partition."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    now = None

    def done() -> Iterator[pa.RecordBatch]:
        if held:
            key = np.concatenate([k for k, _ in held])
            order = np.argsort(key, kind="stable")
            key, n = key[order], np.concatenate([n for _, n in held])[order]
            at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            often = np.add.reduceat(n, at) >= least
            held.clear()
            yield pa.RecordBatch.from_arrays([pa.array(key[at][often].view(np.int64))], names=["key"])

    for batch in batches:
        for part, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if part != now:
                yield from done()
                now = part
            held.append(_unpacked(run))
    yield from done()


_SPELL = 1 << 17


def _spelled(batches: Iterator[pa.RecordBatch], known: sieve.Sieve, bits: int, seed: int) -> Iterator[pa.RecordBatch]:
    """key, lang, id, word, n: the words that may be frequent."""
    held: dict[tuple[int, int, bytes], int] = {}
    names: dict[int, str] = {}

    def sent() -> pa.RecordBatch:
        lang, ids, word = zip(*held, strict=True)
        columns = [np.array(x, np.uint64) for x in (lang, ids)]
        out = [
            pa.array(_hash(columns, bits).view(np.int64)), pa.array([names[x] for x in lang], pa.string()), pa.array(columns[1].view(np.int64)),
            pa.array([x.decode() for x in word], pa.string()), pa.array(list(held.values()), pa.int64()),
        ]
        held.clear()
        return pa.RecordBatch.from_arrays(out, names=["key", "lang", "id", "word", "n"])

    for batch in words.slices(batches, "text", 1 << 21):
        w, (lang, ids), _ = _sequences(batch, 1, seed)
        at = np.flatnonzero(known.open((_hash([lang, ids], bits) & np.uint64(known.bits - 1)).astype(np.int64)))
        if not len(at):
            continue
        names |= _names(batch)
        # words that share an id differ in the second hash, so each is read
        head = w.hash(words.BASES[1] + 2 * seed + 1)[at]
        place, n = _kinds([lang[at], ids[at], head])
        data = w.data.tobytes()
        for i, count in zip(at[place].tolist(), n.tolist(), strict=True):
            kind = int(lang[i]), int(ids[i]), data[w.start[i] : w.end[i]]
            held[kind] = held.get(kind, 0) + count
        if len(held) > _SPELL:
            yield sent()
    if held:
        yield sent()


def _kinds(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The place of a row of each kind, and how many there are."""
    order = np.argsort(_fold(columns))
    new = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    at = np.concatenate([[0], np.flatnonzero(new) + 1])
    return order[at], np.diff(np.append(at, len(order)))


def _counted(batches: Iterator[pa.RecordBatch], k: int, known: sieve.Sieve, bits: int, seed: int, p: Mining) -> Iterator[pa.RecordBatch]:
    """key, lang, ws, n: sorted runs of the sequences of k words that may be frequent."""
    trie = HatTrie(k, p)
    names: dict[int, str] = {}

    def rows(run: Run) -> pa.RecordBatch:
        (lang, *ids), n = run
        flat = np.stack(ids, axis=1).reshape(-1).view(np.int64)
        ws = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, k, dtype=np.int32), pa.array(flat))
        return pa.RecordBatch.from_arrays([pa.array(_hash(run[0], bits).view(np.int64)), pa.array([names[x] for x in lang.tolist()], pa.string()), ws, pa.array(n)], names=["key", "lang", "ws", "n"])

    for batch in words.slices(batches, "text"):
        _, columns, ok = _sequences(batch, k, seed)
        if len(ok):
            at = np.flatnonzero(ok & known.open((_hash(columns, bits) & np.uint64(known.bits - 1)).astype(np.int64)))
            if len(at):
                names |= _names(batch)
                yield from map(rows, trie.add([c[at] for c in columns]))
    yield from map(rows, trie.spill())


def frequent(docs: DataFrame, p: Mining, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases (lang, ws, n) of 1 to `longest` words that occur `least` times, words (lang, id, word), totals (lang, total)."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("lang", F.xxhash64("lang").alias("code"), "text")

    def reach(runs: DataFrame) -> sieve.Sieve:
        keys = runs.repartition("part").sortWithinPartitions("part").mapInArrow(lambda b: _merged(b, p.least), "key long")
        return sieve.of_keys(store.cut(keys), "key")

    bits = 10  # words are few; longer sequences may be as many as words in the texts
    for seed in range(64):  # ids are hashes; if a frequent word shared one, others are taken
        rough = store.cut(rows.mapInArrow(lambda b, s=seed, t=bits: _rough(b, 1, None, (t, t), s, p), _RUNS))
        known = reach(rough.filter("part is not null").select("part", "run"))
        level = rows.mapInArrow(lambda b, s=seed, k=known, t=bits: _spelled(b, k, t, s), "key long, lang string, id long, word string, n long")
        level = level.groupBy("key", "lang", "id").agg(F.sum("n").alias("n"), F.min("word").alias("word"), F.max("word").alias("other"))
        level = store.cut(level.filter(F.col("n") >= p.least))
        if level.filter("word <> other").isEmpty():
            break
    else:
        raise RuntimeError("words share ids under every seed")
    totals = store.cut(rough.filter("part is null").groupBy("lang").agg(F.sum("n").alias("total")))
    spelled = level.select("lang", "id", "word")
    level = level.select("key", "lang", F.array("id").alias("ws"), "n")
    every = totals.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    wide = min(max(1, (every // p.share).bit_length()), 30)
    out = level.select("lang", "ws", "n")
    for k in range(2, p.longest + 1):
        known = sieve.of_keys(level.select("key"), "key")
        runs = rows.mapInArrow(lambda b, k=k, s=known, i=bits, o=wide: _rough(b, k, s, (i, o), seed, p), _RUNS)
        known = reach(runs.select("part", "run"))
        bits = wide
        level = rows.mapInArrow(lambda b, k=k, s=known, t=bits: _counted(b, k, s, t, seed, p), "key long, lang string, ws array<long>, n long")
        level = store.cut(level.groupBy("key", "lang", "ws").agg(F.sum("n").alias("n")).filter(F.col("n") >= p.least))
        if level.isEmpty():
            break
        out = out.union(level.select("lang", "ws", "n"))
    return store.cut(out), spelled, totals


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exact for counts of up to 16 digits."""
    wide = lambda c: c.cast("decimal(17,0)")
    top = (wide(a) * wide(n)).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, params: Mining | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two words or more.

    Texts are lower-cased in A-Z and cut into pieces at `.,;:!?` and line breaks, and these into
    words at spaces and tabs.  A null text has no words, a null language is `und`.  Repeated
    rows count each time; a text without a frequent phrase gives nothing, an empty table no row.
    A candidate is scored by its lowest cut, the shortest first part of equal ones, and goes if
    a longer candidate holds all its occurrences.  Equal scores are ordered by count and then
    phrase, so ranks are unique.  Other columns are not read.
    """
    p = params or Mining()
    found, known, totals = frequent(docs, p, text_col, lang_col)
    size = F.size("ws")
    phrase = found.filter(size > 1).join(totals, "lang").select("lang", "ws", F.col("n").alias("a"), F.col("total").alias("n"))
    cuts = phrase.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumn("left", F.slice("ws", 1, F.col("k"))).withColumn("right", F.slice("ws", F.col("k") + 1, size - F.col("k")))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(found.select("lang", F.col("ws").alias(side), F.col("n").alias(name)), ["lang", side])
    cuts = store.cut(cuts.select("lang", "ws", "a", "n", "k", "left", "right", "l", "r", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score")))
    # a longer phrase that holds all occurrences comes one word at a time, so the next longer ones are enough
    ends = cuts.filter(F.col("k") == size - 1).select("lang", F.col("left").alias("ws"), "a").union(cuts.filter("k = 1").select("lang", F.col("right").alias("ws"), "a"))
    longer = ends.filter(size > 1).groupBy("lang", "ws").agg(F.max("a").alias("longer"))
    best = cuts.groupBy("lang", "ws", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    kept = best.join(longer, ["lang", "ws"], "left").filter(F.coalesce(F.col("longer") < F.col("a"), F.lit(True)))
    kept = store.cut(kept.select("lang", "ws", "a", "n", "cut.score", "cut.l", "cut.r"))
    spelled = kept.select("lang", "ws", F.posexplode("ws").alias("at", "id")).join(known, ["lang", "id"])
    spelled = spelled.groupBy("lang", "ws").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rows = kept.join(spelled, ["lang", "ws"]).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    # each salt's first rows hold the language's, so no task orders all of a language
    first = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= p.report)
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= p.report)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
