"""Page numbers shared by several sources of one book, in reading order.

Every arrival of every source, in order of source rank and unit, meets the numbers that all
earlier ones took: a marked page whose number is taken is a duplicate, an unmarked one gets
the next free number from two after the last page that its source took.  Arrivals that count
on (marked pages n, n+1, n+2 ..., or unmarked ones in a row) are first put together to runs,
in parallel; only one small row per run goes through the ordered scan of its book, which holds
nothing but intervals of taken numbers.  What a run got is joined back to its arrivals.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from variorum.operators import ordered

PAGE, ORPHAN, REVIEW = "page", "orphan", "review"


class Intervals:
    """Disjoint intervals of taken numbers, none touching the next."""

    def __init__(self):
        self.lo: list[int] = []
        self.hi: list[int] = []

    def next_free(self, x: int) -> int:
        at = bisect_right(self.lo, x) - 1
        return self.hi[at] if at >= 0 and x < self.hi[at] else x

    def take(self, lo: int, hi: int) -> list[tuple[int, int]]:
        """Take [lo, hi); the parts of it that were free."""
        first = max(bisect_right(self.lo, lo) - 1, 0)
        if first < len(self.lo) and self.hi[first] < lo:
            first += 1
        last, at, free = first, lo, []
        while last < len(self.lo) and self.lo[last] <= hi:
            if self.lo[last] > at:
                free.append((at, self.lo[last]))
            at = max(at, self.hi[last])
            last += 1
        if at < hi:
            free.append((at, hi))
        if first < last:
            lo, hi = min(lo, self.lo[first]), max(hi, self.hi[last - 1])
        self.lo[first:last], self.hi[first:last] = [lo], [hi]
        return free


_FREE = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))


def _scanned(batches: Iterator[pa.RecordBatch], n_book: int) -> Iterator[pa.RecordBatch]:
    """What each run got; runs come book after book, in order."""
    book = source = None
    taken, last, seen = Intervals(), 0, 0
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(n_book)), strict=True))
        free, numbers, before = [], [], []
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_rank", "kind", "n", "first"))
        for key, rank, kind, n, first in zip(keys, *columns, strict=True):
            if key != book:
                book, source, taken, last, seen = key, None, Intervals(), 0, 0
            if rank != source:
                source, last = rank, 0
            before.append(seen)
            got, made = [], []
            if kind == PAGE:
                got = taken.take(first, first + n)
                if got:
                    last = max(last, got[-1][1] - 1)
            elif kind == ORPHAN:
                for _ in range(n):
                    last = taken.next_free(last + 2)
                    taken.take(last, last + 1)
                    made.append(last)
            seen = max(seen, last)
            free.append([{"lo": lo, "hi": hi} for lo, hi in got])
            numbers.append(made)
        kept = [batch.column(i) for i in range(n_book + 3)]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(free, _FREE), pa.array(numbers, pa.list_(pa.int64())), pa.array(before, pa.int64())],
            names=[*batch.schema.names[: n_book + 3], "_free", "_made", "last_page"],
        )


def shared_numbers(arrivals: DataFrame, book: Sequence[str], rank: str = "source_rank", order: Sequence[str] = ("unit_no", "seg"), bucket_width: int = ordered.BUCKET_WIDTH) -> DataFrame:
    """Arrivals with ``number`` (null for a duplicate or a review item), ``inferred``, ``duplicate`` and ``last_page``.

    ``arrivals`` has the book, ``rank`` (an integer; sources are read in its order), ``order``
    (integers, unique within a source), ``kind`` (``page``, ``orphan`` or ``review``) and
    ``page_number``, null but for a page.  ``last_page`` is the highest number that the book had
    when the arrival's run began, 0 at the start.  Numbers start from 0; a null book is a book.
    """
    book = list(book)
    rows = ordered.with_bucket(arrivals.withColumn("_rank", F.col(rank).cast("long")), order[0], bucket_width, "_bucket")
    part = [*book, "_rank", "_bucket"]
    w = Window.partitionBy(*part).orderBy(*order)
    before = F.lag(F.struct("kind", "page_number")).over(w)
    on = (before["kind"] == F.col("kind")) & ((F.col("kind") != PAGE) | (before["page_number"] + 1 == F.col("page_number")))
    rows = rows.withColumn("_fresh", F.when(F.coalesce(on, F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("_run", F.sum("_fresh").over(w)).drop("_fresh")
    rows = rows.withColumn("_at", F.row_number().over(Window.partitionBy(*part, "_run").orderBy(*order)))
    runs = rows.groupBy(*part, "_run").agg(F.first("kind").alias("kind"), F.count("*").alias("n"), F.min("page_number").cast("long").alias("first"))
    where = [*part, "_run"]
    types = {f.name: f.dataType.simpleString() for f in runs.schema}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in where), "_free array<struct<lo:long,hi:long>>", "_made array<long>", "last_page long"])
    dealt = runs.select(*where, "kind", "n", "first").repartition(F.xxhash64(*book)).sortWithinPartitions(*where)
    found = dealt.mapInArrow(lambda b, k=len(book): _scanned(b, k), schema)
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in where]
    joined = rows.alias("l").join(found.alias("r"), same).select("l.*", "r._free", "r._made", "r.last_page")
    mine = F.exists("_free", lambda x: (x["lo"] <= F.col("page_number")) & (F.col("page_number") < x["hi"]))
    page, orphan = F.col("kind") == PAGE, F.col("kind") == ORPHAN
    number = F.when(page & mine, F.col("page_number").cast("long")).when(orphan, F.element_at("_made", F.col("_at")))
    out = joined.withColumn("number", number).withColumn("inferred", orphan).withColumn("duplicate", page & ~mine)
    return out.drop("_rank", "_bucket", "_run", "_at", "_free", "_made")


def estimated_pages(numbered: DataFrame) -> DataFrame:
    """U8: numbered arrivals that need review with the pages they probably cover: their own, or the one after the last."""
    own = F.when(F.col("kind") == REVIEW, F.array(F.col("last_page") + 1)).otherwise(F.array(F.col("page_number").cast("long")))
    return numbered.filter((F.col("kind") == REVIEW) | F.col("needs_review")).withColumn("estimated_pages", own)
