"""Mixing sources to target weights: fixed-length blocks, drawn per output shard, joined by index.

Each source's documents are laid end to end and cut into blocks of `block` words.  Every
output shard draws how many of its slots each source fills; a source's slots, counted over
all shards, run through a pseudorandom permutation of its block indexes, over and over, so
a block is used again only after all others of its source.  The blocks' texts, cut from the
documents, are joined to the slots by index.  Built-in functions only.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from variorum.llm import store
from variorum.operators import ordered

PRIME = (1 << 31) - 1
_GAP = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Mix:
    """Words of a block, slots of a shard, weights that repeat over the sources, most uses of a block.

    A shard's expected slots of a source are taken whole and only the remainders are drawn
    from the multinomial, which keeps its mean and nearly all of its noise out of small mixes.
    `rows_per_bucket` is how many rows one task orders when documents are laid end to end,
    `rows_per_task` how many slots one task makes, `copies` how many uses of a block one task joins.
    """

    block: int = 32
    shard: int = 8192
    weights: tuple[int, ...] = (1, 2, 3)
    most: int = 3
    seed: int = 11
    rounds: int = 16
    rows_per_bucket: int = 10_000
    rows_per_task: int = 250_000
    copies: int = 8

    def round_keys(self) -> list[tuple[int, int, int]]:
        rng = random.Random(self.seed)
        return [(rng.randrange(1 << 60), rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(self.rounds)]


def _spread(x: Column, a: Column, b: Column) -> Column:
    """A number under PRIME that depends on all of x; plain arithmetic, so any engine can repeat it."""
    y = ((x % PRIME) * a + b + F.floor(x / F.lit(float(PRIME)))) % PRIME
    return (y * y + y) % PRIME


def permuted(x: Column, n: Column, salt: Column, p: Mix) -> Column:
    """Index x of 0..n-1 under a swap-or-not shuffle, a permutation of any n; salt picks which."""
    keys = F.array(*(F.struct(F.lit(k).cast("long").alias("k"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for k, a, b in p.round_keys()))

    def swap(at: Column, key: Column) -> Column:
        other = F.pmod(key["k"] + salt * 1_000_003 - at, n)
        high = F.greatest(at, other)
        return F.when(F.floor(_spread(high + salt, key["a"], key["b"]) / F.lit(128.0)) % 2 == 1, other).otherwise(at)

    return F.aggregate(keys, x.cast("long"), swap)


def permuted_rows(df: DataFrame, x: Column, n: Column, salt: Column, out: str, p: Mix) -> DataFrame:
    """df with `permuted` of x as a column: the same rounds one after another, so that they run as generated code.

    Each round's result comes out of an array of one, as the optimizer would else write every round
    into the next, several times.
    """
    kept = df.columns
    df = df.select("*", F.explode(F.array(x.cast("long"))).alias(out))
    for k, a, b in p.round_keys():
        df = df.withColumn("__other", F.pmod(F.lit(k).cast("long") + salt * 1_000_003 - F.col(out), n))
        coin = _spread(F.greatest(out, "__other") + salt, F.lit(a).cast("long"), F.lit(b).cast("long"))
        swapped = F.when(F.floor(coin / F.lit(128.0)) % 2 == 1, F.col("__other")).otherwise(F.col(out))
        df = df.select(*kept, F.explode(F.array(swapped)).alias(out))
    return df


def sources(sized: DataFrame, p: Mix) -> DataFrame:
    """source, sid, weight, source_size, target, blocks, wanted: one row per source.

    Sources are numbered by code point, null last.  The level at which weights meet the
    total is the largest over all ways to cap the first k sources in order of size by weight.
    """
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.element_at(F.array(*map(F.lit, p.weights)), (F.col("sid") % len(p.weights) + 1).cast("int"))
    every = W.partitionBy()
    filled = W.orderBy(F.col("source_size") / F.col("weight"), "sid")
    before = F.coalesce(F.sum("cap").over(filled.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    weight = F.sum("weight").over(filled.rowsBetween(0, W.unboundedFollowing))
    return (
        total.withColumn("sid", (n - 1).cast("long"))
        .withColumn("weight", cycle.cast("long"))
        .withColumn("cap", p.most * F.col("source_size"))
        .withColumn("all", F.sum("source_size").over(every))
        .withColumn("level", (F.col("all") - before).cast("double") / weight.cast("double"))
        .withColumn("level", F.max("level").over(every))
        .withColumn("target", F.least(F.col("weight") * F.col("level"), F.col("cap").cast("double")))
        .withColumn("blocks", F.ceil(F.col("source_size") / F.lit(float(p.block))))
        .withColumn("wanted", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(F.lit(0.0)))
        .select("source", "sid", "weight", "source_size", "target", "blocks", "wanted")
    )


#: parts of a slot in which remainders are counted, so that their sums are exact
UNITS = 1 << 32


def drawn(plan: DataFrame, p: Mix) -> DataFrame:
    """shard, sid, blocks, first, n: how many slots of each shard a source fills, and how many it filled before.

    All shards but the last are of one size, so expectations are kept per size.  A source with a
    slot or more of each shard has a row per shard; of the others only those drawn have one.
    """
    share = plan.filter("blocks > 0").select("sid", "blocks", "wanted")
    total = share.agg(F.coalesce(F.sum("wanted"), F.lit(0.0)).alias("sum")).select("sum", F.ceil("sum").alias("slots"))
    kinds = total.select("sum", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.lit(p.shard).cast("long").alias("size"), F.lit(0).cast("long").alias("lo"), F.floor(F.col("slots") / F.lit(float(p.shard))).alias("hi")),
        F.struct(F.lit(1).alias("kind"), (F.col("slots") % p.shard).alias("size"), F.floor(F.col("slots") / F.lit(float(p.shard))).alias("lo"), (F.floor(F.col("slots") / F.lit(float(p.shard))) + 1).alias("hi")),
    )).alias("k")).select("sum", "k.*").filter("hi > lo and size > 0")
    mean = F.col("size") * F.col("wanted") / F.col("sum")
    each = share.crossJoin(F.broadcast(kinds)).withColumn("whole", F.floor(mean))  # two kinds of shards at most
    each = store.cut(each.withColumn("part", F.floor((mean - F.col("whole")) * F.lit(float(UNITS)))))
    shards = F.explode(F.sequence("lo", F.col("hi") - 1))
    sure = each.filter("whole > 0").select(shards.alias("shard"), "sid", F.col("whole").alias("n"))
    spare = each.groupBy("kind", "size", "lo", "hi").agg((F.col("size") - F.sum("whole")).alias("open"), F.sum("part").alias("sum"), F.count_if(F.col("part") > 0).alias("cells")).filter("open > 0 and sum > 0")
    spare = store.cut(spare)
    chance = F.pmod(F.xxhash64("shard", "slot", F.lit(p.seed)), F.col("sum"))
    picks = spare.select("kind", "sum", "cells", "open", shards.alias("shard")).withColumn("slot", F.explode(F.sequence(F.lit(1).cast("long"), "open"))).withColumn("u", chance)
    cell = lambda x: F.floor(x.cast("double") / F.col("sum") * F.col("cells"))
    picks = picks.select("kind", "shard", "u", cell(F.col("u")).alias("cell"))
    laid = ordered.running_sum(ordered.with_bucket(each.filter("part > 0"), "sid", name="bucket"), ["kind"], ["sid"], F.col("part"), "from", "bucket")
    laid = laid.select("kind", "sid", "from", (F.col("from") + F.col("part")).alias("to")).join(spare.select("kind", "sum", "cells"), "kind")
    # a source's interval lies in few cells, a draw in one
    laid = laid.select("kind", "sid", "from", "to", F.explode(F.sequence(cell(F.col("from")), cell(F.col("to")))).alias("cell"))
    extra = picks.join(laid, ["kind", "cell"]).filter((F.col("u") >= F.col("from")) & (F.col("u") < F.col("to"))).groupBy("shard", "sid").agg(F.count("*").alias("n"))
    counts = sure.union(extra).groupBy("shard", "sid").agg(F.sum("n").alias("n")).join(share.select("sid", "blocks"), "sid")
    counts = ordered.running_sum(ordered.with_bucket(counts, "shard", name="bucket"), ["sid"], ["shard"], F.col("n"), "first", "bucket").drop("bucket")
    # no block is used more than `most` times
    return counts.withColumn("n", F.least(F.col("n"), F.greatest(p.most * F.col("blocks") - F.col("first"), F.lit(0)))).filter("n > 0").select("shard", "sid", "blocks", "first", "n")


def slots(counts: DataFrame, p: Mix, tasks: int) -> DataFrame:
    """shard, sid, turn, block: the block that each drawn slot takes."""
    turn = counts.repartition(tasks).withColumn("turn", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))
    placed = permuted_rows(turn, F.col("turn") % F.col("blocks"), F.col("blocks"), F.col("sid"), "block", p)
    return placed.select("shard", "sid", "turn", "block")


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, text and 96 bits, never null, that stand for the three."""
    whole = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = [F.col("doc_id").isNull(), F.col("source").isNull(), "doc_id", "source", "text"]
    return whole.select("*", F.xxhash64(*parts).alias("key"), F.hash(*parts).alias("check"))


def laid(docs: DataFrame, p: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The documents with source number and word range within their source, without text, and the sources' plan."""
    words = F.regexp_count("text", F.lit(f"[^{_GAP}]+")).cast("long")
    sized = store.cut(_keyed(docs, id_col, text_col, source_col).select("doc_id", "source", words.alias("size"), "key", "check"))
    plan = store.cut(sources(sized, p))
    buckets = max(1, -(-sized.count() // p.rows_per_bucket))
    rows = sized.join(plan.select("source", "sid").withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s", "source")
    rows = rows.withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets)))
    inside = W.partitionBy("sid", "bucket").orderBy("doc_id", "size", "key", "check").rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy("sid").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    base = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("sum")).select("sid", "bucket", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    rows = rows.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(base, ["sid", "bucket"])
    return rows.select("doc_id", "size", "sid", (F.col("base") + F.col("start")).alias("start"), "key", "check"), plan


def segments(rows: DataFrame, p: Mix) -> DataFrame:
    """sid, block, start, doc_id, n, text: the n words of a document that lie in a block, with the space between them."""
    pad = F.col("start") % p.block
    # words of one letter stand for those before the document in its first block, so that each match is one block's part
    matches = F.regexp_extract_all(F.concat(F.expr(f"repeat('x ', cast(start % {p.block} as int))"), F.col("text")), F.lit(f"(?:[^{_GAP}]++[{_GAP}]*+){{1,{p.block}}}+"), F.lit(0))
    cut = rows.filter("size > 0").select("doc_id", "size", "sid", "start", pad.alias("pad"), F.posexplode(matches).alias("k", "part"))
    cut = cut.withColumn("block", F.floor(F.col("start") / F.lit(float(p.block))) + F.col("k"))
    part = F.when(F.col("k") == 0, F.expr("substring(part, cast(2 * pad + 1 as int))")).otherwise(F.col("part"))
    inside = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * p.block) - F.greatest(F.col("start"), F.col("block") * p.block)
    return cut.select("sid", "block", "start", "doc_id", inside.alias("n"), F.btrim(part, F.lit(" \t\n\x0b\f\r")).alias("text"))


def _filled(docs: DataFrame, rows: DataFrame, plan: DataFrame, p: Mix, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """shard, turn, sid, block, parts: the drawn slots with what their block holds of each document, in order."""
    counts = store.cut(drawn(plan, p))
    # a shard's slots are many rows made from one, so they are dealt out before
    blocks = plan.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    turns = slots(counts, p, max(1, -(-blocks // p.rows_per_task))).join(plan.select("sid", "blocks"), "sid")
    turns = turns.withColumn("deal", F.floor(F.col("turn") / (F.col("blocks") * F.lit(float(p.copies))))).drop("blocks")
    # a block that is used often goes to several tasks, each of which joins some of its uses
    deals = counts.groupBy("sid", "blocks").agg(F.max(F.col("first") + F.col("n")).alias("end"))
    deals = deals.select("sid", F.floor((F.col("end") - 1) / (F.col("blocks") * F.lit(float(p.copies)))).alias("last"))
    # rows that repeat in all of id, source and text are paired by number
    same = W.partitionBy("key", "check")
    texts = _keyed(docs, id_col, text_col, source_col).select("key", "check", "text").withColumn("t", F.row_number().over(same.orderBy("key")))
    ranges = rows.filter("size > 0").withColumn("r", F.row_number().over(same.orderBy("start")))
    # not an equality of columns, so that both sides keep the partitioning of their window
    pair = (texts["key"] == ranges["key"]) & (texts["check"] == ranges["check"]) & (F.col("t") - F.col("r") == 0)
    whole = texts.join(ranges, pair).select("doc_id", "size", "sid", "start", "text")
    parts = segments(whole, p).join(deals, "sid").withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))).drop("last")
    filled = parts.groupBy("sid", "block", "deal").agg(F.sort_array(F.collect_list(F.struct("start", "doc_id", "n", "text"))).alias("parts"))
    return turns.join(filled.hint("merge"), ["sid", "block", "deal"]).select("shard", "turn", "sid", "block", "parts")


def mixture(docs: DataFrame, params: Mix | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """shard, turn, sid, block, parts, text: the mix, one row per slot of its output shards.

    A block's parts (start, doc_id, n, text) are its documents' shares in order: where the
    document begins in its source, and its n words in the block as they stand there; `text` is
    the parts with a line break between them.  Every block has `block` words but for its source's
    last.  `turn` counts a source's slots over all shards; sources are numbered as in `sources`.
    """
    p = params or Mix()
    rows, plan = laid(docs, p, id_col, text_col, source_col)
    filled = _filled(docs, rows, plan, p, id_col, text_col, source_col)
    return filled.withColumn("text", F.array_join(F.transform("parts", lambda x: x["text"]), "\n"))


def mix(docs: DataFrame, params: Mix | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", out: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per row of `docs`, how many of its words the mix holds.

    The words are counted in the rows of the mix (`mixture`), which is written to the folder
    `out`, in zstd, if one is given.  A null text has size 0 and is taken 0 times; a null source is a
    source, the last.  Repeated rows are documents of their own.  Other columns are not read.
    """
    p = params or Mix()
    rows, plan = laid(docs, p, id_col, text_col, source_col)
    rows = store.cut(rows)
    filled = _filled(docs, rows, plan, p, id_col, text_col, source_col)
    if out is not None:
        filled.withColumn("text", F.array_join(F.transform("parts", lambda x: x["text"]), "\n")).write.parquet(out, compression="zstd")
        filled = docs.sparkSession.read.parquet(out)
    # rows laid from one start differ in their size, but for empty ones
    taken = filled.select("sid", F.explode("parts").alias("x")).groupBy("sid", F.col("x.start").alias("start")).agg(F.sum("x.n").alias("taken"))
    found = rows.select("doc_id", "size", "sid", "start").join(taken, ["sid", "start"], "left").join(plan.select("sid", "source_size", "target"), "sid")
    result = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long")
    return found.select(F.col("doc_id").alias(id_col), "size", "source_size", "target", result.alias("taken"))
