"""Sequence alignment: the one place where Python does the comparing.

Spark has no Ratcliff-Obershelp matcher, so ``difflib`` runs inside Arrow
functions.  Inputs are blank-joined token strings (one string per reading is far
cheaper to ship than a list of strings); outputs are flat Arrow arrays.  All that
follows - index maps, anchors, spans, votes - is done on the opcodes in the JVM.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from difflib import Match, SequenceMatcher, get_close_matches
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types

from variorum.functions import text as T
from variorum.params import DEFAULT, Params

# ship these functions by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = "struct<a:int,b:int,size:int>"


def _array_of(**fields: types.DataType) -> types.ArrayType:
    return types.ArrayType(types.StructType([types.StructField(k, v) for k, v in fields.items()]))


_INT = types.IntegerType()
OPCODES = _array_of(tag=types.StringType(), i1=_INT, i2=_INT, j1=_INT, j2=_INT)
BLOCKS = _array_of(a=_INT, b=_INT, size=_INT)
ANCHORS = _array_of(i=_INT, j=_INT)

_OPCODE_PA = pa.struct([("tag", pa.string()), ("i1", pa.int32()), ("i2", pa.int32()), ("j1", pa.int32()), ("j2", pa.int32())])
_ANCHOR_PA = pa.struct([("i", pa.int32()), ("j", pa.int32())])
_BLOCK_PA = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("size", pa.int32())])


SLICE = 1 << 20  # bytes of text that are compared at a time
_ACCENTS, _EMPTY = str.maketrans(T._NFD_SRC, T._NFD_DST), T.EMPTY_FOLD


def _split(s: str) -> list[str]:
    return s.split(" ") if s else []


def _folded_word(w: str) -> str:
    """A lower-case word as ``T.fold_keeping_tokens`` folds it."""
    return w if w.isascii() else w.translate(_ACCENTS).encode("ascii", "ignore").decode("ascii") or _EMPTY


class _Matcher(SequenceMatcher):
    """``difflib``'s matcher with a longest-match scan that survives repetitive text.

    The plain scan visits every pair of equal tokens; in a table or a loop that is
    most of the square.  A match of at least k tokens is also a run of equal
    k-grams, and those are far rarer, so long grams are tried first and single
    tokens only when no longer match exists.  Every scan returns the same block:
    the longest, then the earliest on the left, then the earliest on the right.
    """

    GRAMS = (8, 3)

    def __init__(self, a: list[str], b: list[str]):
        super().__init__(None, a, b, autojunk=False)
        self._hits = {}
        for k in self.GRAMS:
            where: dict[tuple, list[int]] = {}
            for j in range(len(b) - k + 1):
                where.setdefault(tuple(b[j : j + k]), []).append(j)
            self._hits[k] = [where.get(tuple(a[i : i + k])) for i in range(len(a) - k + 1)]

    def find_longest_match(self, alo=0, ahi=None, blo=0, bhi=None):
        ahi = len(self.a) if ahi is None else ahi
        bhi = len(self.b) if bhi is None else bhi
        for k in self.GRAMS:
            found = self._by_grams(k, alo, ahi, blo, bhi)
            if found is not None:
                return found
        return super().find_longest_match(alo, ahi, blo, bhi)

    def _by_grams(self, k: int, alo: int, ahi: int, blo: int, bhi: int) -> Match | None:
        hits, last = self._hits[k], bhi - k
        best = besti = bestj = 0
        runs: dict[int, int] = {}
        for i in range(alo, ahi - k + 1):
            js = hits[i]
            if js is None:
                runs = {}
                continue
            now = {}
            for j in js:
                if j < blo:
                    continue
                if j > last:
                    break
                n = now[j] = runs.get(j - 1, 0) + 1
                if n > best:
                    best, besti, bestj = n, i - n + 1, j - n + 1
            runs = now
        return Match(besti, bestj, best + k - 1) if best else None


class _Runs(SequenceMatcher):
    """``difflib``'s blocks from one pass over the texts.

    Runs of equal k-grams are found once; a part of the texts has those that reach into it, cut to
    it, and its longest match is the longest of them.  A part without a run of k words is searched
    again for shorter ones.  Texts with too many equal k-grams start with a longer k, those that
    repeat at every k are left to ``_Matcher``.
    """

    def __init__(self, a: list[str], b: list[str]):
        self.a, self.b = a, b
        self.matching_blocks = self.opcodes = None

    def get_matching_blocks(self) -> list[Match]:
        if self.matching_blocks is None:
            found: list[tuple[int, int, int]] = []
            _search(self.a, self.b, 0, 0, (3, 8, 16, 32), found)
            found.sort()
            out, at = [], (0, 0, 0)
            for i, j, n in found:  # blocks that touch are one
                if at[0] + at[2] == i and at[1] + at[2] == j:
                    at = (at[0], at[1], at[2] + n)
                    continue
                if at[2]:
                    out.append(Match(*at))
                at = (i, j, n)
            if at[2]:
                out.append(Match(*at))
            self.matching_blocks = [*out, Match(len(self.a), len(self.b), 0)]
        return self.matching_blocks


def _runs(a: list[str], b: list[str], k: int) -> list[tuple[int, int, int]] | None:
    """The maximal equal runs (i, j, n) of at least k words, or None if equal k-grams are too many."""
    where: dict[tuple, list[int]] = {}
    for j, g in enumerate(zip(*(b[x:] for x in range(k)))):
        if g in where:
            where[g].append(j)
        else:
            where[g] = [j]
    out: list[tuple[int, int, int]] = []
    live: dict[int, int] = {}  # where a run is on the right: where it began on the left
    left, get = 8 * (len(a) + len(b)), where.get
    i = -1
    for i, g in enumerate(zip(*(a[x:] for x in range(k)))):
        js = get(g)
        if js is None and not live:
            continue
        now = {}
        if js is not None:
            left -= len(js)
            if left < 0:
                return None
            for j in js:
                s = live.pop(j - 1, None)
                now[j] = i if s is None else s
        if live:
            out += [(s, j + 1 - i + s, i - s + k - 1) for j, s in live.items()]
        live = now
    return out + [(s, j - i + s, i - s + k) for j, s in live.items()]


def _search(a: list[str], b: list[str], i0: int, j0: int, sizes: tuple[int, ...], out: list[tuple[int, int, int]]) -> None:
    """The blocks of two lists of words, moved by i0 and j0; ``sizes`` are the k tried, ascending."""
    for x, k in enumerate(sizes):
        runs = _runs(a, b, k)
        if runs is not None:
            break
    else:
        out += [(m.a + i0, m.b + j0, m.size) for m in _Matcher(a, b).get_matching_blocks() if m.size]
        return
    todo = [(0, len(a), 0, len(b), runs)]
    while todo:
        alo, ahi, blo, bhi, runs = todo.pop()
        if not runs:
            if x:
                _search(a[alo:ahi], b[blo:bhi], i0 + alo, j0 + blo, sizes[:x], out)
            else:
                _search_short(a, b, alo, ahi, blo, bhi, i0, j0, out)
            continue
        i, j, n = min(runs, key=lambda r: (-r[2], r[0], r[1])) if len(runs) > 1 else runs[0]
        out.append((i + i0, j + j0, n))
        if alo < i and blo < j:
            before = ((p, q, min(m, i - p, j - q)) for p, q, m in runs if p < i and q < j)
            todo.append((alo, i, blo, j, [r for r in before if r[2] >= k]))
        i, j = i + n, j + n
        if i < ahi and j < bhi:
            after = []
            for p, q, m in runs:
                d = max(i - p, j - q, 0)
                if m - d >= k:
                    after.append((p + d, q + d, m - d))
            todo.append((i, ahi, j, bhi, after))


def _search_short(a: list[str], b: list[str], alo: int, ahi: int, blo: int, bhi: int, i0: int, j0: int, out: list[tuple[int, int, int]]) -> None:
    """The blocks of a part in which no match has three words."""
    todo = [(alo, ahi, blo, bhi)]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        where: dict[str, list[int]] = {}
        for j in range(blo, bhi):
            where.setdefault(b[j], []).append(j)
        bi = bj = n = 0
        for i in range(alo, ahi):
            js = where.get(a[i])
            if not js:
                continue
            if not n:
                bi, bj, n = i, js[0], 1
            two = next((j for j in js if j + 1 < bhi and b[j + 1] == a[i + 1]), None) if i + 1 < ahi else None
            if two is not None:
                bi, bj, n = i, two, 2
                break
        if n:
            out.append((bi + i0, bj + j0, n))
            if alo < bi and blo < bj:
                todo.append((alo, bi, blo, bj))
            if bi + n < ahi and bj + n < bhi:
                todo.append((bi + n, ahi, bj + n, bhi))


def _matcher(x: str, y: str) -> SequenceMatcher:
    return _Runs(_split(x), _split(y))


class _Texts:
    """The words of some pairs of texts as numbers, one side's after the other's in one stream each.

    ``a`` and ``b`` are the streams, ``ab`` and ``bb`` where each pair's words begin in them (and, last, their ends).
    """

    def __init__(self, left: pa.Array, right: pa.Array, fold: bool):
        parts, starts = [], []
        for side in (left, right):
            words = pc.split_pattern(side, " ")
            n = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            empty = pc.fill_null(pc.equal(side, ""), False).to_numpy(zero_copy_only=False)  # no words, not one empty word
            flat = words.flatten()
            parts.append(flat.filter(pa.array(~np.repeat(empty, n))) if empty.any() else flat)
            starts.append(np.concatenate(([0], np.cumsum(np.where(empty, 0, n)))))
        self.ab, self.bb = starts
        coded = pa.concat_arrays(parts).dictionary_encode()
        ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if fold and len(coded.dictionary):
            words = pa.array([_folded_word(w) for w in coded.dictionary.to_pylist()], pa.string()).dictionary_encode()
            ids = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)[ids]
        self.a, self.b = ids[: self.ab[-1]], ids[self.ab[-1] :]
        self.none = (pc.is_null(left).to_numpy(zero_copy_only=False)) | (pc.is_null(right).to_numpy(zero_copy_only=False))

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``difflib``'s blocks of every pair: pair, place left, place right, words; the places are those in the streams."""
        ab, bb, n = self.ab, self.bb, np.diff(self.ab)
        same = (n == np.diff(bb)) & (n > 0) & ~self.none
        for r in np.flatnonzero(same):
            same[r] = np.array_equal(self.a[ab[r] : ab[r + 1]], self.b[bb[r] : bb[r + 1]])
        other = np.flatnonzero(~same & ~self.none)
        found = self._within(ab[other], ab[other + 1], bb[other], bb[other + 1], (3, 8, 16, 32))
        i, j, m = (np.concatenate(x) for x in zip(found, (ab[:-1][same], bb[:-1][same], n[same])))
        order = np.argsort(i, kind="stable")
        i, j, m = i[order], j[order], m[order]
        pair = np.searchsorted(ab, i, "right") - 1
        # blocks that touch are one
        first = np.ones(len(i), bool)
        first[1:] = (pair[1:] != pair[:-1]) | (i[1:] != i[:-1] + m[:-1]) | (j[1:] != j[:-1] + m[:-1])
        heads = np.flatnonzero(first)
        return pair[heads], i[heads], j[heads], np.add.reduceat(m, heads) if len(heads) else m

    def _within(self, i0: np.ndarray, i1: np.ndarray, j0: np.ndarray, j1: np.ndarray, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The blocks of parts [i0, i1) and [j0, j1) of the streams, all parts at once; ``sizes`` are the k tried, ascending.

        Runs of k words that cross no other are blocks; among those that do, the longest is taken
        first.  What lies between the blocks is searched again for shorter runs, parts with too many
        equal k-grams for longer ones; those that repeat at every k are left to ``_Matcher``.
        """
        none = np.zeros(0, np.int64)
        out = [(none, none, none)]
        for x, k in enumerate(sizes):
            if not len(i0):
                break
            in_a, in_b = _ranges(i0, i1), _ranges(j0, j1)
            part_a, part_b = np.repeat(np.arange(len(i0)), i1 - i0), np.repeat(np.arange(len(i0)), j1 - j0)
            runs, hard = _equal_runs(self.a[in_a], self.b[in_b], part_a, part_b, k, i1 - i0 + j1 - j0)
            i, j, m = _longest_first(*runs, k)
            part, i, j = part_a[i], in_a[i], in_b[j]
            out.append((i, j, m))
            if k > 1:
                done = np.flatnonzero(~hard)
                start, left, right, end = _gaps(part, i, j, m, done, i0, i1, j0, j1)
                out.append(self._within(start, left, right, end, sizes[:x] or (1,)))
            i0, i1, j0, j1 = i0[hard], i1[hard], j0[hard], j1[hard]
        for g in range(len(i0)):
            more: list[tuple[int, int, int]] = []
            a, b = self.a[i0[g] : i1[g]].tolist(), self.b[j0[g] : j1[g]].tolist()
            if sizes == (1,):
                _search_short(a, b, 0, len(a), 0, len(b), 0, 0, more)
            else:
                more = [tuple(r) for r in _Matcher(a, b).get_matching_blocks() if r.size]
            p, q, m = np.array(more, np.int64).reshape(-1, 3).T
            out.append((p + i0[g], q + j0[g], m))
        return tuple(np.concatenate(c) for c in zip(*out))

    def opcodes(self) -> pa.Array:
        pair, i, j, m = self.blocks()
        n = len(self.none)
        pair, i, j, m = (np.concatenate(x) for x in ((pair, np.arange(n)), (i, self.ab[1:]), (j, self.bb[1:]), (m, np.zeros(n, np.int64))))
        order = np.argsort(pair, kind="stable")  # the end of a pair is after its blocks
        pair, i, j, m = pair[order], i[order], j[order], m[order]
        base_i, base_j = self.ab[pair], self.bb[pair]
        i0, j0 = np.concatenate(([0], (i + m)[:-1])), np.concatenate(([0], (j + m)[:-1]))
        first = np.ones(len(i), bool)
        first[1:] = pair[1:] != pair[:-1]
        i0, j0 = np.where(first, base_i, i0), np.where(first, base_j, j0)
        # two slots a block: the change before it and itself
        tag = np.stack([(i > i0) + 2 * (j > j0), np.where(m > 0, 4, 0)], 1).ravel()
        there = (tag > 0) & ~np.repeat(self.none[pair], 2)
        spans = [np.stack(x, 1).ravel()[there].astype(np.int32) for x in ((i0 - base_i, i - base_i), (i - base_i, i + m - base_i), (j0 - base_j, j - base_j), (j - base_j, j + m - base_j))]
        tags = pa.array(["", "delete", "insert", "replace", "equal"], pa.string()).take(pa.array(tag[there]))
        values = pa.StructArray.from_arrays([tags, *(pa.array(x, pa.int32()) for x in spans)], fields=list(_OPCODE_PA))
        return _listed(np.bincount(np.repeat(pair, 2)[there], minlength=n), values, self.none)

    def matching(self) -> pa.Array:
        pair, i, j, m = self.blocks()
        values = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (i - self.ab[pair], j - self.bb[pair], m)], fields=list(_BLOCK_PA))
        return _listed(np.bincount(pair, minlength=len(self.none)), values, self.none)

    def ratios(self) -> pa.Array:
        pair, _, _, m = self.blocks()
        hits = np.bincount(pair, weights=m, minlength=len(self.none))
        words = np.diff(self.ab) + np.diff(self.bb)
        return pa.array(2.0 * hits / np.maximum(words, 1), pa.float64(), mask=self.none)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, end to end."""
    n = hi - lo
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def _gaps(part: np.ndarray, i: np.ndarray, j: np.ndarray, m: np.ndarray, parts: np.ndarray, i0: np.ndarray, i1: np.ndarray, j0: np.ndarray, j1: np.ndarray):
    """What lies before, between and after the blocks of each of ``parts``, where both sides have words there."""
    part, i, j, m = (np.concatenate(x) for x in ((part, parts), (i, i1[parts]), (j, j1[parts]), (m, np.zeros(len(parts), np.int64))))
    order = np.lexsort((i, part))
    part, i, j, m = part[order], i[order], j[order], m[order]
    first = np.ones(len(i), bool)
    first[1:] = part[1:] != part[:-1]
    a = np.where(first, i0[part], np.concatenate(([0], (i + m)[:-1])))
    b = np.where(first, j0[part], np.concatenate(([0], (j + m)[:-1])))
    gap = (i > a) & (j > b)
    return a[gap], i[gap], b[gap], j[gap]


def _equal_runs(a: np.ndarray, b: np.ndarray, part_a: np.ndarray, part_b: np.ndarray, k: int, sizes: np.ndarray):
    """The maximal equal runs (i, j, n) of at least k words within each part, by place, and the parts with too many equal k-grams."""
    at_a, at_b = (np.flatnonzero(p[: len(p) - k + 1] == p[k - 1 :]) if len(p) >= k else np.zeros(0, np.int64) for p in (part_a, part_b))
    most = int(max(a.max(initial=0), b.max(initial=0))) + 1
    key, bound = np.concatenate((part_a[at_a], part_b[at_b])), len(sizes)
    for x in range(k):
        if bound * most >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            bound = len(key)
        key = key * most + np.concatenate((a[at_a + x], b[at_b + x]))
        bound *= most
    in_a, in_b = key[: len(at_a)], key[len(at_a) :]
    order = np.argsort(in_b, kind="stable")
    in_b = in_b[order]
    lo, hi = np.searchsorted(in_b, in_a, "left"), np.searchsorted(in_b, in_a, "right")
    hard = np.bincount(part_a[at_a], weights=hi - lo, minlength=len(sizes)) > 8 * sizes
    hi = np.where(hard[part_a[at_a]], lo, hi)
    i, j = np.repeat(at_a, hi - lo), at_b[order[_ranges(lo, hi)]]
    # along a diagonal, neighbours are one run
    d = j - i
    by = np.argsort((d - d.min(initial=0)) * (len(a) + 1) + i, kind="stable")
    i, j, d = i[by], j[by], d[by]
    first = np.ones(len(i), bool)
    first[1:] = (d[1:] != d[:-1]) | (i[1:] != i[:-1] + 1) | (part_a[i[1:]] != part_a[i[:-1]])
    heads = np.flatnonzero(first)
    n = np.diff(np.append(heads, len(i))) + k - 1
    i, j = i[heads], j[heads]
    by = np.lexsort((j, i))
    return (i[by], j[by], n[by]), hard


def _longest_first(i: np.ndarray, j: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of runs by place, those that stay when the longest is taken first and cuts the others (the first on the left, then on the right, of equals)."""
    if not len(i):
        return i, j, n
    # between two runs where none reaches over, on either side, what comes before has no part in what comes after
    apart = (np.maximum.accumulate(i + n)[:-1] <= i[1:]) & (np.maximum.accumulate(j + n)[:-1] <= np.minimum.accumulate(j[::-1])[::-1][1:])
    heads = np.concatenate(([0], np.flatnonzero(apart) + 1))
    sizes = np.diff(np.append(heads, len(i)))
    alone = heads[sizes == 1]
    out: list[tuple[int, int, int]] = []
    for h, s in zip(heads[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        todo = [list(zip(i[h : h + s].tolist(), j[h : h + s].tolist(), n[h : h + s].tolist()))]
        while todo:
            runs = todo.pop()
            if not runs:
                continue
            x, y, m = min(runs, key=lambda r: (-r[2], r[0], r[1])) if len(runs) > 1 else runs[0]
            out.append((x, y, m))
            if len(runs) == 1:
                continue
            before = ((p, q, min(l, x - p, y - q)) for p, q, l in runs if p < x and q < y)
            todo.append([r for r in before if r[2] >= k])
            x, y, after = x + m, y + m, []
            for p, q, l in runs:
                c = max(x - p, y - q, 0)
                if l - c >= k:
                    after.append((p + c, q + c, l - c))
            todo.append(after)
    more = np.array(out, np.int64).reshape(-1, 3)
    i, j, n = (np.concatenate((v[alone], more[:, c])) for c, v in enumerate((i, j, n)))
    by = np.argsort(i, kind="stable")
    return i[by], j[by], n[by]


def _listed(counts: np.ndarray, values: pa.Array, none: np.ndarray) -> pa.ListArray:
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=pa.array(none) if none.any() else None)


def _by_slices(a: pa.Array, b: pa.Array, result: Callable[[_Texts], pa.Array], fold: bool = False) -> pa.Array:
    """The result for all pairs, worked out for about a megabyte of them at a time."""
    sizes = np.cumsum(sum(pc.fill_null(pc.binary_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b)))
    out, at = [], 0
    while at < len(a) or not out:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE, "right"))) if len(a) else 0
        out.append(result(_Texts(a.slice(at, end - at), b.slice(at, end - at), fold)))
        at = end
    return pa.concat_arrays(out)


def _struct_lists(rows: list, kind: pa.StructType) -> pa.ListArray:
    flat, offsets, valid = [], [0], []
    for row in rows:
        valid.append(row is not None)
        flat.extend(row or ())
        offsets.append(len(flat))
    cols = list(zip(*flat)) or [()] * kind.num_fields
    values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kind)], fields=list(kind))
    mask = None if all(valid) else pa.array([not v for v in valid])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=mask)


def _pairs(a: pa.Array, b: pa.Array):
    return zip(a.to_pylist(), b.to_pylist())


@F.arrow_udf(OPCODES)
def opcodes(a: pa.Array, b: pa.Array) -> pa.Array:
    """A1: opcodes turning token string a into b."""
    return _by_slices(a, b, _Texts.opcodes)


@F.arrow_udf(OPCODES)
def _opcodes_folded(a: pa.Array, b: pa.Array) -> pa.Array:
    return _by_slices(a, b, _Texts.opcodes, fold=True)


def opcodes_folded(a: Column, b: Column) -> Column:
    """A1: opcodes of two token strings under N1, which keeps every token's slot.

    Letters are lowered by Spark; the rest of the fold is done on the words that need it, each
    once, where they are compared.
    """
    return _opcodes_folded(F.lower(a), F.lower(b))


@F.arrow_udf(types.DoubleType())
def ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    """A2: similarity 2*matches/(len a + len b); an empty side scores 0."""
    return _by_slices(a, b, _Texts.ratios)


@F.arrow_udf(BLOCKS)
def matching_blocks(a: pa.Array, b: pa.Array) -> pa.Array:
    """A4: matching blocks, without the closing empty one."""
    return _by_slices(a, b, _Texts.matching)


def anchors_once(n: int) -> Callable[[Column, Column], Column]:
    """Places (i, j) of the n-grams that occur once in either token string and cross no other such n-gram."""

    @F.arrow_udf(ANCHORS)
    def anchors(a: pa.Array, b: pa.Array) -> pa.Array:
        return _struct_lists([None if x is None or y is None else _calm(_once(_split(x), n), _once(_split(y), n)) for x, y in _pairs(a, b)], _ANCHOR_PA)

    return anchors


def _once(words: list[str], n: int) -> dict[tuple, int]:
    """The n-grams that occur once, in order, with their place."""
    where: dict[tuple, int] = {}
    for i, g in enumerate(zip(*(words[k:] for k in range(n)))):
        where[g] = -1 if g in where else i
    return {g: i for g, i in where.items() if i >= 0}


def _calm(left: dict[tuple, int], right: dict[tuple, int]) -> list[tuple[int, int]]:
    hits = sorted((i, right[g]) for g, i in left.items() if g in right)
    least = list(accumulate((j for _, j in reversed(hits)), min))[::-1]
    out, most = [], -1
    for x, (i, j) in enumerate(hits):
        if most < j and (x + 1 == len(hits) or least[x + 1] > j):
            out.append((i, j))
        most = max(most, j)
    return out


def close_match(candidates: tuple[str, ...], cutoff: float) -> Callable[[Column], Column]:
    """A10: nearest of a fixed list of strings, or null.

    A ratio of at least ``cutoff`` bounds the length ratio, so lines that cannot
    reach it are nulled in the JVM and never compared in Python.
    """

    @F.arrow_udf(types.StringType())
    def nearest(words: pa.Array) -> pa.Array:
        memo: dict[str, str | None] = {}
        for w in words.to_pylist():
            if w is not None and w not in memo:
                hit = get_close_matches(w, candidates, n=1, cutoff=cutoff)
                memo[w] = hit[0] if hit else None
        return pa.array([memo.get(w) for w in words.to_pylist()], pa.string())

    def apply(word: Column) -> Column:
        if not candidates:
            return F.lit(None).cast("string")
        reach = cutoff / (2 - cutoff)
        possible = F.lit(False)
        for n in sorted({len(c) for c in candidates}):
            possible = possible | ((F.length(word) >= n * reach) & (F.length(word) <= n / reach))
        return nearest(F.when(possible, word))

    return apply


def equal_runs(ops: Column) -> Column:
    """Opcodes of equal runs only."""
    return F.filter(ops, lambda o: o["tag"] == "equal")


def changes(ops: Column) -> Column:
    """Opcodes of disagreements only."""
    return F.filter(ops, lambda o: o["tag"] != "equal")


def index_map(ops: Column) -> Column:
    """A3: for every left index its right index, null where unmatched.

    Opcodes tile the left side, so laying their ranges end to end gives the map
    in one linear pass without exploding tokens.
    """
    none = F.lit(None).cast("int")
    return F.flatten(
        F.transform(
            F.filter(ops, lambda o: o["i2"] > o["i1"]),
            lambda o: F.when(o["tag"] == "equal", F.sequence(o["j1"], F.greatest(o["j2"] - 1, o["j1"]))).otherwise(
                F.array_repeat(none, o["i2"] - o["i1"])
            ),
        )
    )


def mapped_count(imap: Column) -> Column:
    """Number of matched left indices."""
    return F.size(F.filter(imap, lambda x: x.isNotNull()))


def _present(imap: Column, start: Column, n: Column) -> Column:
    """Mapped values among n entries from 0-based start."""
    stop = F.least(start + n, F.size(imap))
    at = F.transform(F.sequence(start, F.greatest(stop - 1, start)), lambda i: F.get(imap, i))
    return F.when(stop > start, F.filter(at, lambda x: x.isNotNull())).otherwise(F.array().cast("array<int>"))


def anchors(imap: Column, i1: Column, i2: Column, back: int, forward: Column) -> tuple[Column, Column]:
    """Right-side positions just after the nearest match before i1 and at the nearest match from i2 on."""
    n = F.least(i1, F.lit(back))
    before = F.try_element_at(_present(imap, i1 - n, n), F.lit(-1)) + 1
    after = F.get(_present(imap, i2, forward), F.lit(0))
    return before, after


def anchor_span(imap: Column, n_mapped: Column, right: Column, i1: Column, i2: Column, params: Params = DEFAULT) -> Column:
    """A5: what the third reading has where the first has [i1, i2); null when unknown."""
    before, after = anchors(imap, i1, i2, params.anchor_back, F.least(F.lit(params.anchor_forward), n_mapped))
    width = i2 - i1 + 2

    def bounds(x: Column) -> Column:
        # greatest() skips nulls, so the missing side has to be asked for
        lo = F.coalesce(x["before"], F.when(x["after"].isNotNull(), F.greatest(F.lit(0), x["after"] - width)))
        hi = F.coalesce(x["after"], F.least(F.size(right), lo + width))
        return F.struct(lo.alias("lo"), hi.alias("hi"))

    at = T.let(F.struct(before.alias("before"), after.alias("after")), bounds)
    return T.let(at, lambda x: F.when(x["lo"].isNotNull() & (x["hi"] > x["lo"]), F.nullif(take_words(right, x["lo"], x["hi"]), F.lit(""))))


def inspan_bounds(imap: Column, n_mapped: Column, i1: Column, i2: Column, cap_by_map: bool, params: Params = DEFAULT) -> Column:
    """struct(c1, c2) covering the matches inside [i1, i2), else between both outer anchors, else null."""
    inside = _present(imap, i1, i2 - i1)
    reach = F.lit(params.inspan_forward)
    before, after = anchors(imap, i1, i2, params.inspan_back, F.least(reach, n_mapped) if cap_by_map else reach)

    def bounds(x: Column) -> Column:
        found = F.size(x["inside"]) > 0
        c1 = F.when(found, F.array_min(x["inside"])).otherwise(x["before"])
        c2 = F.when(found, F.array_max(x["inside"]) + 1).otherwise(x["after"])
        return F.when(c1.isNotNull() & c2.isNotNull(), F.struct(c1.alias("c1"), c2.alias("c2")))

    return T.let(F.struct(inside.alias("inside"), before.alias("before"), after.alias("after")), bounds)


def take_words(words: Column, lo: Column, hi: Column) -> Column:
    """Blank-joined words[lo:hi]."""
    return F.array_join(T.cut(words, lo, hi), " ")


def texts_match(a: Column, b: Column) -> Column:
    """Equal N2 token lists, tokens that fold to nothing ignored."""

    def norms(words: Column) -> Column:
        return F.filter(F.transform(words, T.fold_strong), lambda x: x != "")

    def kept(words: Column) -> Column:
        return F.array_join(F.array_remove(F.split(T.fold_strong_line(words), " "), T.EMPTY_FOLD), " ")

    # a fold with blanks in it, or a word that stands for an empty fold, is compared word by word
    odd = F.concat_ws(" ", a, b).rlike(f"{T._BLANKS}|{T.EMPTY_FOLD}")
    return F.when(odd | a.isNull() | b.isNull(), norms(a) == norms(b)).otherwise(kept(a) == kept(b))


def best_boundary_overlap(blocks: Column, n_tail: Column, params: Params = DEFAULT) -> Column:
    """Longest matching block near the end of the tail and the start of the head; earliest wins ties."""
    ok = F.filter(
        blocks,
        lambda m: (m["size"] >= params.overlap_min_words)
        & (m["b"] <= params.overlap_max_head)
        & (m["a"] + m["size"] >= n_tail - params.overlap_tail_reach),
    )
    ranked = F.transform(ok, lambda m, i: F.struct(m["size"].alias("size"), (-i).alias("rank"), m["b"].alias("head_start")))
    best = F.array_max(ranked)
    return F.struct(F.coalesce(best["head_start"], F.lit(0)).alias("head_start"), F.coalesce(best["size"], F.lit(0)).alias("match_len"))


def diff_segments(ops: Column, left: Column, right: Column) -> Column:
    """The two sequences as match / del / ins segments in reading order."""

    def seg(kind: str, words: Column, lo: Column, hi: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), take_words(words, lo, hi).alias("words"))

    parts = F.transform(
        ops,
        lambda o: F.when(o["tag"] == "equal", F.array(seg("match", left, o["i1"], o["i2"])))
        .when(o["tag"] == "delete", F.array(seg("del", left, o["i1"], o["i2"])))
        .when(o["tag"] == "insert", F.array(seg("ins", right, o["j1"], o["j2"])))
        .otherwise(F.array(seg("del", left, o["i1"], o["i2"]), seg("ins", right, o["j1"], o["j2"]))),
    )
    return F.flatten(parts)
