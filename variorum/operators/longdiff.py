"""Token diff of texts of any length, in tasks of bounded size.

A text is a stream of words over many rows, cut by position into blocks.  N-grams that occur
once on either side are anchors, and anchors on one diagonal a run.  The heaviest chain of runs
that increases on both sides is found in two steps: the longest run of each block of
positions stands for it, and one small row per text chains these; then each stretch between
two chosen runs chains its own.  Chain runs are where the texts are cut, one cut for some
thousand words, and what lies between two cuts is aligned apart.  Stretches without an anchor
are searched again for shorter n-grams that are unique within the stretch.

Cuts lie where both texts agree, so the result is a diff whatever was cut; a text short enough
for one piece is aligned whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types
from pyspark.sql.window import Window

from variorum.functions import align as A
from variorum.functions import text as T
from variorum.operators import ordered
from variorum.scratch import checkpoint_folder


@dataclass(frozen=True)
class Long:
    """Words of a block, words between cuts, words of the longest stretch that is aligned, and n-gram sizes tried.

    Stretches over ``longest`` on either side that share no unique n-gram of any size are
    reported as one change without alignment.
    """

    block: int = 4096
    chunk: int = 2048
    longest: int = 16384
    grams: tuple[int, ...] = (8, 4, 2)


_RUN = types.ArrayType(types.StructType([types.StructField(c, types.LongType()) for c in ("i", "j", "n")]))
_RUN_PA = pa.list_(pa.struct([(c, pa.int64()) for c in ("i", "j", "n")]))


def chain(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The heaviest chain of runs (i, j, n) that increases on both sides; runs are disjoint on either."""
    runs = sorted(runs)
    ends = sorted(j + n for _, j, n in runs)
    best: list[tuple[int, int]] = [(0, -1)] * (len(ends) + 1)  # a tree of prefix maxima over the right ends
    before = [-1] * len(runs)
    top = (0, -1)
    for x, (_, j, n) in enumerate(runs):
        at, found = bisect_left(ends, j + 1), (0, -1)  # ends up to j lie before the run
        while at > 0:
            found = max(found, best[at], key=lambda v: v[0])
            at -= at & -at
        before[x] = found[1]
        mine = (found[0] + n, x)
        at = bisect_left(ends, j + n) + 1
        while at <= len(ends):
            if best[at][0] < mine[0]:
                best[at] = mine
            at += at & -at
        if mine[0] > top[0]:
            top = mine
    out, x = [], top[1]
    while x >= 0:
        out.append(runs[x])
        x = before[x]
    return out[::-1]


def _chained(runs: Column) -> Column:
    """The heaviest chain of a row's runs."""
    pick = chain

    @F.arrow_udf(_RUN)
    def heaviest(rows: pa.Array) -> pa.Array:
        out = [None if r is None else [dict(zip("ijn", x, strict=True)) for x in pick([(v["i"], v["j"], v["n"]) for v in r])] for r in rows.to_pylist()]
        return pa.array(out, _RUN_PA)

    return heaviest(runs)


def _cut(df: DataFrame) -> DataFrame:
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def _lines(parts: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """keys, side, order, line, _n: the words of each part blank-joined and counted, made once for all that ask for them."""
    return _cut(parts.select(*keys, "side", order, F.array_join("words", " ").alias("line"), F.size("words").cast("long").alias("_n")))


def _sizes(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, n_a, n_b: words of both sides of each text."""
    return lines.groupBy(*keys).agg(*(F.coalesce(F.sum(F.when(F.col("side") == s, F.col("_n"))), F.lit(0)).cast("long").alias(f"n_{s}") for s in "ab"))


def _started(lines: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """keys, side, order, line, _n, start: lines with the words of their side before them; words are shuffled blank-joined."""
    rows = ordered.with_bucket(lines, order, name="_bucket")
    return ordered.running_sum(rows, [*keys, "side"], [order], F.col("_n"), "start", "_bucket").drop("_bucket")


def stream(parts: DataFrame, keys: Sequence[str], order: str = "part_no") -> DataFrame:
    """Parts (keys, side, order, words) as lines of ``_n`` words with ``start``, the words of their side before them."""
    return _started(_lines(parts, keys, order), keys, order)


def blocks(streamed: DataFrame, keys: Sequence[str], p: Long, over: int) -> DataFrame:
    """keys, side, block, line: the words from block * size on, with ``over`` words of what follows.

    Words have no blanks and travel blank-joined: as lists they take four times the room.
    """
    rows = streamed.filter("_n > 0").withColumn("_end", F.col("start") + F.col("_n")).withColumn("words", F.split("line", " "))
    first, last = (F.floor(x / F.lit(float(p.block))) for x in (F.greatest(F.col("start") - over, F.lit(0)), F.col("_end") - 1))
    rows = rows.withColumn("block", F.explode(F.sequence(first, last)))
    lo = F.greatest("start", F.col("block") * p.block)
    hi = F.least("_end", (F.col("block") + 1) * p.block + over)
    cut = F.slice("words", (lo - F.col("start") + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int"))
    rows = rows.filter(hi > lo).select(*keys, "side", "block", F.struct(lo.alias("at"), F.array_join(cut, " ").alias("ws")).alias("_p"))
    laid = rows.groupBy(*keys, "side", "block").agg(F.sort_array(F.collect_list("_p")).alias("_p"))
    return laid.select(*keys, "side", "block", F.array_join("_p.ws", " ").alias("line"))


def anchor_runs(laid: DataFrame, keys: Sequence[str], n: int, p: Long) -> DataFrame:
    """keys, block, i, j, n: runs of n-grams that occur once on either side, by block of the left side."""

    def grams(ws: Column) -> Column:
        count = F.least(F.size(ws) - n + 1, F.lit(p.block))
        at = F.when(count > 0, F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda t: F.xxhash64(F.slice(ws, t + 1, F.lit(n))))

    each = laid.select(*keys, "side", "block", F.posexplode(T.let(F.split("line", " "), grams)).alias("t", "h"))
    pos = F.col("block") * p.block + F.col("t")
    left, right = (F.col("side") == x for x in "ab")
    once = each.groupBy(*keys, "h").agg(
        F.count_if(left).alias("_a"), F.count_if(right).alias("_b"), F.max(F.when(left, pos)).alias("i"), F.max(F.when(right, pos)).alias("j")
    )
    hits = once.filter("_a = 1 and _b = 1").select(*keys, "i", "j", (F.col("i") - F.col("j")).alias("_d"), F.floor(F.col("i") / F.lit(float(p.block))).alias("block"))
    same = [*keys, "block", "_d"]
    rank = F.row_number().over(Window.partitionBy(*same).orderBy("i"))
    runs = hits.withColumn("_r", F.col("i") - rank).groupBy(*same, "_r").agg(F.min("i").alias("i"), F.min("j").alias("j"), F.count("*").alias("n"))
    return runs.select(*keys, "block", "i", "j", "n")


def chained_runs(runs: DataFrame, keys: Sequence[str], p: Long) -> DataFrame:
    """keys, i, j, n: the runs of the chain.

    One row per text holds one run per block; a stretch between two chosen runs holds the runs
    that fit between them on both sides.
    """
    run = F.struct("i", "j", "n")
    heads = runs.groupBy(*keys, "block").agg(F.max_by(run, F.struct(F.col("n"), -F.col("i"))).alias("_h"))
    heads = heads.groupBy(*keys).agg(F.collect_list("_h").alias("_h"), F.max("block").alias("_last"))
    chosen = _cut(heads.select(*keys, "_last", _chained(F.col("_h")).alias("_h")))
    edge = lambda i, n: F.array(F.struct(*(F.lit(v).cast("long").alias(c) for c, v in zip("ijn", (i, i, n), strict=True))))
    marks = F.concat(edge(-1, 1), "_h", edge((1 << 62), 0))
    gaps = chosen.select(*keys, "_last", F.explode(F.arrays_zip(F.slice(marks, 1, F.size("_h") + 1).alias("lo"), F.slice(marks, 2, F.size("_h") + 1).alias("hi"))).alias("g"))
    first, last = F.floor(F.greatest(F.col("g.lo.i"), F.lit(0)) / F.lit(float(p.block))), F.least(F.floor(F.col("g.hi.i") / F.lit(float(p.block))), F.col("_last"))
    gaps = gaps.filter(last >= first).select(*keys, "g", F.explode(F.sequence(first, last)).alias("block"))
    inside = (F.col("i") >= F.col("g.lo.i") + F.col("g.lo.n")) & (F.col("i") < F.col("g.hi.i")) & (F.col("j") >= F.col("g.lo.j") + F.col("g.lo.n")) & (F.col("j") + F.col("n") <= F.col("g.hi.j"))
    fitting = runs.join(gaps, [*keys, "block"]).filter(inside)
    local = fitting.groupBy(*keys, F.col("g.lo.i").alias("_at")).agg(F.collect_list(run).alias("_h"))
    every = chosen.select(*keys, "_h").union(local.select(*keys, _chained(F.col("_h")).alias("_h")))
    return every.select(*keys, F.explode("_h").alias("_h")).select(*keys, "_h.*")


def _cuts(laid: DataFrame, keys: Sequence[str], n: int, p: Long, ends: bool = False) -> DataFrame:
    """keys, i, j: a cut for each ``chunk`` words of the left side, in the middle of the chain's longest run there, or at both its ends."""
    found = chained_runs(_cut(anchor_runs(laid, keys, n, p)), keys, p)
    longest = F.max_by(F.struct("i", "j", "n"), F.struct(F.col("n"), -F.col("i")))
    rows = found.groupBy(*keys, F.floor(F.col("i") / F.lit(float(p.chunk))).alias("_c")).agg(longest.alias("r"))
    steps = F.array(F.lit(0).cast("long"), F.col("r.n")) if ends else F.array(F.floor(F.col("r.n") / F.lit(2.0)))
    return rows.select(*keys, "r", F.explode(steps).alias("_s")).select(*keys, (F.col("r.i") + F.col("_s")).alias("i"), (F.col("r.j") + F.col("_s")).alias("j"))


def _stretches(cuts: DataFrame, sizes: DataFrame, keys: Sequence[str], p: Long) -> DataFrame:
    """keys, i1, i2, j1, j2: what lies between two cuts, or a cut and an end."""
    zero = sizes.select(*keys, F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"))
    rows = ordered.with_bucket(cuts.union(zero).distinct(), "i", p.block * 4096, "_bucket")
    rows = ordered.neighbour(rows, keys, ["i", "j"], ["i", "j"], "_next", "_bucket")
    rows = rows.join(sizes, list(keys))
    rows = rows.select(*keys, F.col("i").alias("i1"), F.coalesce("_next.i", "n_a").alias("i2"), F.col("j").alias("j1"), F.coalesce("_next.j", "n_b").alias("j2"))
    return rows.filter("i2 > i1 or j2 > j1")


def _words(stretches: DataFrame, laid: DataFrame, keys: Sequence[str], p: Long) -> DataFrame:
    """keys, i1, i2, j1, j2, side, block, words: the words of each stretch, by block."""
    asked = stretches.select(*keys, "i1", "i2", "j1", "j2", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(lo).alias("lo"), F.col(hi).alias("hi")) for s, lo, hi in (("a", "i1", "i2"), ("b", "j1", "j2"))))).alias("r"))
    asked = asked.select(*keys, "i1", "i2", "j1", "j2", "r.*").filter("hi > lo")
    asked = asked.withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / F.lit(float(p.block))), F.floor((F.col("hi") - 1) / F.lit(float(p.block))))))
    # a block goes to its key as one string and is split there, once for all stretches
    n = int(laid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    there = laid.repartition(n, *keys, "side", "block").select(*keys, "side", "block", F.split("line", " ").alias("words"))
    met = asked.join(there, [*keys, "side", "block"])
    base = F.col("block") * p.block
    lo, hi = F.greatest(F.col("lo"), base), F.least(F.col("hi"), base + p.block)
    return met.select(*keys, "i1", "i2", "j1", "j2", "side", "block", F.slice("words", (lo - base + 1).cast("int"), (hi - lo).cast("int")).alias("words"))


def _line(side: str) -> Column:
    """The blank-joined words of one side of a group, by block."""
    return F.array_join(F.sort_array(F.collect_list(F.when(F.col("side") == side, F.struct("block", "line")))).getField("line"), " ")


def _placed(i1: str, j1: str, ops: str, a: str, b: str) -> Column:
    """The changes of two lines by position in the whole texts, with their words: a line is cut into words once, not once per change."""
    given = F.struct(F.col(i1).alias("i"), F.col(j1).alias("j"), F.split(a, " ").alias("a"), F.split(b, " ").alias("b"), F.col(ops).alias("ops"))

    def cut(x: Column, o: Column) -> Column:
        i, j = x["i"], x["j"]
        return F.struct(
            (o["i1"] + i).alias("i1"), (o["i2"] + i).alias("i2"), (o["j1"] + j).alias("j1"), (o["j2"] + j).alias("j2"),
            o["tag"].alias("tag"), A.take_words(x["a"], o["i1"], o["i2"]).alias("t1"), A.take_words(x["b"], o["j1"], o["j2"]).alias("t2"),
        )

    return T.let(given, lambda x: F.transform(A.changes(x["ops"]), lambda o: cut(x, o)))


def changes(parts: DataFrame, keys: Sequence[str], params: Long | None = None, order: str = "part_no") -> DataFrame:
    """keys, i1, i2, j1, j2, tag, t1, t2: what turns side a into side b, by position in the whole texts.

    ``parts`` has ``side`` (``a`` or ``b``), ``order`` (an integer, unique on its side) and ``words``;
    no row is larger than its part, no task's row larger than some blocks.  A text with one side
    only is one insertion or deletion.  Words are null in a change too long to be aligned.
    """
    p = params or Long()
    given, keys = list(keys), list(keys) or ["_text"]
    parts = parts if given else parts.withColumn("_text", F.lit(0))
    lines = _lines(parts, keys, order)
    laid = _cut(blocks(_started(lines, keys, order), keys, p, max(p.grams) - 1))
    sizes = _cut(_sizes(lines, keys))
    over = (F.col("i2") - F.col("i1") > p.longest) | (F.col("j2") - F.col("j1") > p.longest)
    open_ = over & (F.col("i2") > F.col("i1")) & (F.col("j2") > F.col("j1"))
    found = None
    for level, n in enumerate(p.grams):
        if level == 0:
            found = _cuts(laid, keys, n, p)
        else:
            left = _cut(_stretches(found, sizes, keys, p).filter(open_))
            if left.isEmpty():
                break
            # each stretch is a text of its own, its blocks are its parts
            inner = [*keys, "i1", "j1"]
            sub = _words(left, laid, keys, p).select(*inner, "side", F.col("block").alias("_b"), "words")
            sub = _cut(blocks(stream(sub, inner, "_b"), inner, p, n - 1))
            more = _cuts(sub, inner, n, p, ends=True).select(*keys, (F.col("i") + F.col("i1")).alias("i"), (F.col("j") + F.col("j1")).alias("j"))
            found = found.union(more)
        found = _cut(found)
    whole = _stretches(found, sizes, keys, p)
    near = _words(whole.filter(~over), laid, keys, p).withColumn("line", F.array_join("words", " ")).drop("words")
    at = [*keys, "i1", "i2", "j1", "j2"]
    rows = near.groupBy(*at).agg(_line("a").alias("_a"), _line("b").alias("_b"))
    rows = rows.filter(F.col("_a") != F.col("_b")).withColumn("_ops", A.opcodes("_a", "_b"))
    # outer, as every row left has a change: a plain explode asks first, and cuts the words for it
    placed = rows.select(*keys, F.explode_outer(_placed("i1", "j1", "_ops", "_a", "_b")).alias("o")).select(*keys, "o.*")
    tag = F.when(F.col("i2") == F.col("i1"), "insert").when(F.col("j2") == F.col("j1"), "delete").otherwise("replace")
    none = F.lit(None).cast("string")
    return placed.union(whole.filter(over).select(*keys, "i1", "i2", "j1", "j2", tag.alias("tag"), none.alias("t1"), none.alias("t2"))).drop(*(k for k in keys if k not in given))


def replayed(parts: DataFrame, found: DataFrame, keys: Sequence[str], params: Long | None = None, order: str = "part_no") -> DataFrame:
    """keys, n_a, n_b, n_kept, replays: whether side b is side a with the changes made, word by word.

    What lies between two changes must be as long on both sides and have the same words; it is
    compared in pieces of one block.
    """
    p = params or Long()
    given, keys = list(keys), list(keys) or ["_text"]
    if not given:
        parts, found = (x.withColumn("_text", F.lit(0)) for x in (parts, found))
    lines = _lines(parts, keys, order)
    sizes = _sizes(lines, keys)
    ends = found.select(*keys, "i1", "j1", "i2", "j2").union(sizes.select(*keys, *(F.lit(x).cast("long") for x in (-1, -1, 0, 0))))
    # the changes are asked for twice, by place and by bucket, and are an alignment to make
    ends = _cut(ordered.with_bucket(ends, "i2", p.block * 4096, "_bucket"))
    kept = ordered.neighbour(ends, keys, ["i2", "j2"], ["i1", "j1"], "_next", "_bucket").join(sizes, keys)
    kept = kept.select(*keys, F.col("i2").alias("i1"), F.coalesce("_next.i1", "n_a").alias("i2"), F.col("j2").alias("j1"), F.coalesce("_next.j1", "n_b").alias("j2"))
    even = kept.groupBy(*keys).agg(F.bool_and(F.col("i2") - F.col("i1") == F.col("j2") - F.col("j1")).alias("_even"), F.sum(F.col("i2") - F.col("i1")).alias("n_kept"))
    size = F.least(F.col("i2") - F.col("i1"), F.col("j2") - F.col("j1"))
    steps = kept.filter(size > 0).withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((size - 1) / F.lit(float(p.block)))))).withColumn("_s", F.col("_s") * p.block)
    ends_at = F.least(F.col("_s") + p.block, size)
    pieces = steps.select(*keys, (F.col("i1") + F.col("_s")).alias("i1"), (F.col("i1") + ends_at).alias("i2"), (F.col("j1") + F.col("_s")).alias("j1"), (F.col("j1") + ends_at).alias("j2"))
    laid = blocks(_started(lines, keys, order), keys, p, 0)
    words = _words(pieces, _cut(laid), keys, p).withColumn("line", F.array_join("words", " ")).drop("words")
    same = words.groupBy(*keys, "i1", "j1").agg((_line("a") == _line("b")).alias("_ok")).groupBy(*keys).agg(F.bool_and("_ok").alias("_ok"))
    out = sizes.join(even, keys).join(same, keys, "left")
    replays = F.col("_even") & F.coalesce("_ok", F.lit(True))
    return out.select(*given, "n_a", "n_b", "n_kept", replays.alias("replays"))
