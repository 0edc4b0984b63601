"""A bounded bitmap of wanted ids, to drop most other rows before anything is shuffled.

It may let others through, so a join by id still decides; it never drops a wanted one.  Its
size follows the number of ids up to `MOST_BITS`, beyond which it only lets more through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 26
#: bits of one piece: what `bitmap_construct_agg` makes
PIECE = 32768


@dataclass(frozen=True)
class Sieve:
    bits: int
    data: bytes

    def place(self, key: Column) -> Column:
        """The bit of a key; give it to `open` inside the task."""
        return F.pmod(F.xxhash64(key), F.lit(self.bits).cast("long"))

    def open(self, at: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.data, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def _filled(rows: DataFrame, n: int, place: Callable[[int], Column]) -> Sieve:
    """At most MOST_BITS / PIECE pieces of 4,096 bytes come to the driver."""
    bits = PIECE
    while bits < min(MOST_BITS, 16 * n):
        bits *= 2
    out = np.zeros(bits // 8, np.uint8)
    rows = rows.select(place(bits).alias("at")).groupBy(F.shiftright("at", 15).alias("piece")).agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(PIECE - 1)).alias("map"))
    for r in rows.collect():
        out[r["piece"] * PIECE // 8 : (r["piece"] + 1) * PIECE // 8] = np.frombuffer(bytes(r["map"]), np.uint8)
    return Sieve(bits, out.tobytes())


def made(ids: DataFrame, column: str) -> Sieve:
    """The sieve of a column of ids."""
    return _filled(ids, ids.count(), lambda bits: F.pmod(F.xxhash64(column), F.lit(bits).cast("long")))


def of_keys(keys: DataFrame, column: str) -> Sieve:
    """The sieve of a column of keys that are hashes already; a key's bit is its lowest bits."""
    return _filled(keys, keys.count(), lambda bits: F.col(column).bitwiseAND(F.lit(bits - 1).cast("long")))
