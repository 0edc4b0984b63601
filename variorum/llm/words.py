"""Word arrays of Arrow text batches, as numpy arrays over the text bytes.

A word is a run of bytes other than space and tab to carriage return, so whole
texts are cut without a Python loop over words.  Used inside Arrow tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# seeds of the word hashes; any two numbers do
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: modulus of the polynomials: a prime, so that no word's structure cancels whatever the base
PRIME = (1 << 31) - 1
_P, _BITS = np.uint64(PRIME), np.uint64(31)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: which bits of a lane the first 0 to 8 bytes are
_LANE = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits of the hash."""
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


def _folded(x: np.ndarray) -> np.ndarray:
    """A number under 2**33 that equals x modulo the prime."""
    return (x & _P) + (x >> _BITS)


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime."""
    x = _folded(_folded(x))
    return np.where(x >= _P, x - _P, x)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo the prime, for i up to n; kept per process."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 16)
        out = []
        for b in (base, pow(base, -1, PRIME)):
            p = np.ones(size, np.uint64)
            have_n = 1
            while have_n < size:
                more = min(have_n, size - have_n)
                p[have_n : have_n + more] = _reduced(p[:more] * np.uint64(pow(b, have_n, PRIME)))
                have_n += more
            out.append(p)
        have = out[0], out[1]
        if size <= 1 << 22:
            _POWERS[base] = have
    return have


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """64-bit hash of values[start:end] for each pair, by two running polynomials modulo a prime.

    Values are hashes of 64 bits, of which each polynomial takes other 31 bits.
    """
    n = len(values)
    halves = []
    for side in range(2):
        up, down = powers((base >> (31 * side)) % (PRIME - 2) + 2, n)
        part = (values >> np.uint64(2 + 31 * side)) & _P
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_folded(part * up[:n]), out=total[1:])
        halves.append(_reduced(_reduced(total[end] - total[start]) * down[start]))
    return mix((halves[0] << _BITS | halves[1]) ^ np.uint64(base))


@dataclass
class Words:
    """The words of some texts: byte range and hash of each, and each text's first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # one more than there are texts

    def hash(self, base: int = BASES[0]) -> np.ndarray:
        """A 64-bit hash of each word: the sum of its mixed lanes of eight bytes, each mixed with its place."""
        n = len(self.start)
        if not n:
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        lanes = (size + 7) >> 3
        first = np.cumsum(lanes) - lanes
        owner = np.repeat(np.arange(n), lanes)
        place = np.arange(len(owner)) - first[owner]
        at = self.start[owner] + 8 * place
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        value = np.ndarray((len(self.data) + 1,), "<u8", padded, 0, (1,))[at] & _LANE[np.minimum(self.end[owner] - at, 8)]
        value = mix(mix(value + np.uint64(base)) + place.astype(np.uint64) * _M1)
        return mix(np.add.reduceat(value, first) + size.astype(np.uint64) * _M2)


def cut(texts: pa.Array, lower: bool = False, gap: np.ndarray = _SPACE) -> Words:
    """The words of every text of an Arrow string array, cut at the bytes of `gap`; null has none."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    lo, hi = (int(offsets[0]), int(offsets[-1])) if n else (0, 0)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8, hi - lo, lo) if hi > lo else np.zeros(0, np.uint8)
    offsets = offsets - lo
    if texts.null_count:  # what lies under a null does not count
        gone = np.flatnonzero(texts.is_null().to_numpy(zero_copy_only=False))
        if any(offsets[i] < offsets[i + 1] for i in gone):
            return cut(pa.array([None if x is None else x for x in texts.to_pylist()], pa.large_string()), lower, gap)
    word = ~gap[data]
    if lower:
        data = _LOWER[data]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    opens[inner] = word[inner]
    closes[inner - 1] = word[inner - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `most` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string())
        ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
