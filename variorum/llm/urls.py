"""URL filters: a Bloom filter cascade gives exact membership of a URL's keys in a list, without joins.

A listed key is a host and the beginning of a path.  Every URL asks for the keys that could
list it: each suffix of its host with each path beginning as long as a listed one.  Level 0
of the cascade holds the listed keys; level 1 the keys of the corpus's whole key universe
that level 0 takes by mistake; level 2 the listed keys that level 1 takes by mistake, and so
on until no mistake is left.  So the answer is exact for every key of the universe, and the
filters go along as literals.  Their size is known from the number of keys before they are
made, and is checked; a list whose filters would be too large is joined by key instead, to the
same result.  Built-in functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variorum.functions.text import let
from variorum.llm import store

#: bits of one piece of a filter: what `bitmap_construct_agg` makes
PIECE = 32768


@dataclass(frozen=True)
class Cascade:
    """Bits for each key and hashes on each level; the most bits that may go along as literals, levels and verdicts.

    A list beyond any of these is joined by key.
    """

    bits_per_key: int = 10
    hashes: int = 5
    most_bits: int = 1 << 26
    most_levels: int = 64
    most_verdicts: int = 16


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its size in bits and its non-empty pieces of 4,096 bytes by number."""

    bits: int
    pieces: dict[int, bytes]


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """The keys that could list a URL, longest first and of equal ones that with the longer host."""
    labels = F.split(host, r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.array(*(F.substring(path, 1, n) for n in sorted(lengths, reverse=True)))
    starts = F.array_distinct(F.filter(starts, lambda x: x != ""))
    pairs = F.flatten(F.transform(suffix, lambda h: F.transform(starts, lambda s: F.struct((-F.length(h) - F.length(s)).alias("size"), (-F.length(h)).alias("host"), F.concat(h, s).alias("key")))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(F.array_sort(pairs), lambda x: x["key"]))


def _places(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    """The bits of a key on a level, from 0."""
    a, b = (F.pmod(h, F.lit(1 << 40).cast("long")) for h in (F.xxhash64(key, F.lit(level)), F.xxhash64(F.lit(level), key)))
    return [F.pmod(a + b * i, F.lit(bits).cast("long")) for i in range(hashes)]


def _bits(n: int, c: Cascade) -> int:
    """The bits of a filter of n keys."""
    return max(64, n * c.bits_per_key)


def _level(keys: DataFrame, level: int, n: int, c: Cascade) -> Level:
    """The filter of n keys; its bits are counted before, its pieces made by Spark's bitmap aggregate."""
    bits = _bits(n, c)
    at = keys.select(F.explode(F.array(*_places(F.col("key"), level, bits, c.hashes))).alias("at"))
    rows = at.groupBy(F.floor(F.col("at") / F.lit(float(PIECE))).alias("piece")).agg(F.bitmap_construct_agg((F.col("at") % PIECE)).alias("bits"))
    return Level(bits, {r["piece"]: bytes(r["bits"]) for r in rows.collect()})  # at most most_bits / PIECE rows


def _takes(key: Column, number: int, level: Level, c: Cascade) -> Column:
    """Whether the level's filter takes the key."""
    full = b"".join(level.pieces.get(i, bytes(PIECE // 8)) for i in range(math.ceil(level.bits / PIECE)))
    data = F.lit(full)
    test = F.lit(True)
    for at in _places(key, number, level.bits, c.hashes):
        byte = F.conv(F.hex(F.substring(data, (F.floor(at / F.lit(8.0)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        test = test & (F.getbit(byte, (at % 8).cast("int")) == 1)
    return test


def member(key: Column, levels: list[Level], c: Cascade) -> Column:
    """Exact membership of a key of the universe: the parity of the first level that does not take it."""
    out = F.lit(len(levels) % 2 == 1)
    for number in reversed(range(len(levels))):
        out = F.when(_takes(key, number, levels[number], c), out).otherwise(F.lit(number % 2 == 1))
    return out


def build(listed: DataFrame, universe: DataFrame, c: Cascade) -> list[Level] | None:
    """The cascade of the listed keys over the universe of keys; both are tables of `key`.

    None if its filters together would take more than `most_bits`, or it more than `most_levels`.
    """
    listed = store.cut(listed.select("key").distinct())
    # all keys of the universe that are not listed; only level 0's mistakes are kept of them
    levels: list[Level] = []
    mine, n = listed, listed.count()
    other = universe.select("key").distinct().join(listed, "key", "left_anti")
    while n:
        if len(levels) == c.most_levels or sum(x.bits for x in levels) + _bits(n, c) > c.most_bits:
            return None
        levels.append(_level(mine, len(levels), n, c))
        wrong = store.cut(other.filter(_takes(F.col("key"), len(levels) - 1, levels[-1], c)))
        mine, other, n = wrong, mine, wrong.count()
    return levels


Listed = DataFrame | list[tuple[str, str]]


def _checked(spark: SparkSession, table: Listed) -> DataFrame:
    """A table of listed keys (key, verdict), each once."""
    if isinstance(table, list):
        table = spark.createDataFrame(table, "key string, verdict string")
    table = store.cut(table.select(F.col("key").cast("string"), F.col("verdict").cast("string")).distinct())
    if not table.filter(F.col("key").isNull() | F.col("verdict").isNull() | (F.instr("key", "/") == 0)).isEmpty():
        raise ValueError("a listed key is a host and the beginning of a path, with a verdict")
    if not table.groupBy("key").count().filter("count > 1").isEmpty():
        raise ValueError("a key is listed with two verdicts")
    return table


def _hit(asked: Column, cascades: dict[str, list[Level]], c: Cascade) -> Column:
    """The first of the keys that is listed, with its verdict; null if none is."""

    def fit(key: Column) -> Column:
        said = F.lit(None).cast("string")
        for verdict, levels in cascades.items():
            said = F.when(member(key, levels, c), F.lit(verdict)).otherwise(said)
        return F.struct(key.alias("rule"), said.alias("verdict"))

    return let(asked, lambda keys: F.get(F.filter(F.transform(keys, fit), lambda x: x["verdict"].isNotNull()), F.lit(0)))


def _joined(places: DataFrame, asked: Column, table: DataFrame, out: str) -> DataFrame:
    """host, path, out: the first listed key of each place, by a join on the key; places without one are left out."""
    keys = places.select("host", "path", F.posexplode(asked).alias("at", "key"))
    first = F.min(F.struct("at", "key", "verdict"))
    found = keys.join(table, "key").groupBy("host", "path").agg(first.alias("x"))
    return store.cut(found.select("host", "path", F.struct(F.col("x.key").alias("rule"), F.col("x.verdict").alias("verdict")).alias(out)))


def _with_hit(rows: DataFrame, table: Listed, c: Cascade, out: str) -> DataFrame:
    """rows with the listed key that decides each, and its verdict, as `out`; null if none does."""
    table = _checked(rows.sparkSession, table)
    # at most as many as the longest path has characters
    lengths = sorted(r["n"] for r in table.select((F.length("key") - F.instr("key", "/") + 1).alias("n")).distinct().collect())
    if not lengths:
        return rows.withColumn(out, F.lit(None).cast("struct<rule:string,verdict:string>"))
    asked = keys_of(F.col("host"), F.col("path"), lengths)
    # a host alone asks for few keys, so copies of a host and path are taken together first
    places = rows.select("host", "path").distinct()
    universe = places.select(F.explode(asked).alias("key"))
    cascades: dict[str, list[Level]] = {}
    bits = 0
    for verdict in (r["verdict"] for r in table.select("verdict").distinct().orderBy("verdict").limit(c.most_verdicts + 1).collect()):
        levels = build(table.filter(F.col("verdict") == verdict), universe, c) if len(cascades) < c.most_verdicts else None
        bits += sum(x.bits for x in levels or ())
        if levels is None or bits > c.most_bits:
            return rows.join(_joined(places, asked, table, out), ["host", "path"], "left")
        cascades[verdict] = levels
    return rows.withColumn(out, _hit(asked, cascades, c))


def judged(pages: DataFrame, rules: Listed, params: Cascade | None = None, id_col: str = "page_id", url_col: str = "url", default: str = "allow", listed: Listed | None = None) -> DataFrame:
    """id_col, host, path, rule, verdict: every URL under rules (key, verdict).

    A key is a host and the beginning of a path, such as `org/` or `com/de/`.  It fits its host
    and all subdomains, if the path starts as it says; the longest wins.  Where no rule fits,
    the longest key of `listed` that fits gives the verdict, with a null rule; where none does,
    `default`.  Rules and `listed` are DataFrames (key, verdict) or lists of pairs.  A null URL,
    or one without `://`, has an empty host and path and no rule.  Rows that repeat are judged
    alike; other columns are not read.  Keys listed twice in one table must agree.
    """
    c = params or Cascade()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = _with_hit(rows, rules, c, "hit")
    rest = F.lit(None).cast("string")
    if listed is not None:
        rows = _with_hit(rows, listed, c, "more")
        rest = F.when(F.col("hit").isNull(), F.col("more.verdict"))
    return rows.select(F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", rest, F.lit(default)).alias("verdict"))
