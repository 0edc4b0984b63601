"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Templates are sorted in classes by length, up to L tokens each.  A text is cut in windows of
2L tokens, one every L, so an occurrence lies whole in some window and makes up at least a
quarter of it.  With bands of one row, enough of them to meet at that similarity with the
stated probability, a window that holds a template collides with it; then the share of the
template's shingles in the window is counted exactly.  Built-in functions only.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variorum.functions.text import let

PRIME = (1 << 31) - 1
# fixed values: wordings by which public licenses are named or granted
TEMPLATES = (
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
)


@dataclass(frozen=True)
class Scan:
    """Tokens of a shingle, chance that a held template is not retrieved, and share of its shingles that counts as held."""

    shingle: int = 3
    miss: float = 1e-4
    held: float = 0.9
    seed: int = 3

    def width(self, tokens: int) -> int:
        """The class of a template: the least power of two, from 8, that holds its tokens."""
        return max(8, 1 << (tokens - 1).bit_length())

    def bands(self) -> int:
        """Hashes that meet the miss chance at the least similarity of a window and a template of its class held in it."""
        least = min(self.held * (max(w // 2 + 1, 5) - self.shingle + 1) / (2 * w - self.shingle + 1) for w in (8, 16, 32, 64, 128, 256))
        return math.ceil(math.log(self.miss) / math.log(1 - least))


def tokens_of(text: Column) -> Column:
    """Runs of a-z and 0-9 of the text in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "[^a-z0-9]+"), lambda x: x != "")


def shingles_of(tokens: Column, p: Scan) -> Column:
    """Hash of each run of `shingle` tokens, in order."""
    n = F.size(tokens) - p.shingle
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), lambda i: F.xxhash64(*(tokens[i + k] for k in range(p.shingle))))).otherwise(F.array().cast("array<bigint>"))


def minima(shingles: Column, p: Scan) -> Column:
    """Minimum of each universal hash over a set of shingles."""
    rng = random.Random(p.seed)
    keys = F.array(*(F.struct(F.lit(rng.randrange(1, PRIME)).cast("long").alias("a"), F.lit(rng.randrange(PRIME)).cast("long").alias("b")) for _ in range(p.bands())))
    return F.transform(keys, lambda k: F.array_min(F.transform(shingles, lambda x: (F.pmod(x, F.lit(PRIME).cast("long")) * k["a"] + k["b"]) % PRIME)))


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...], p: Scan) -> DataFrame:
    """template, license, width, shingles, size: one row per template of at least a shingle."""
    import re

    rows = [(i, name, text, p.width(len(re.findall("[a-z0-9]+", text.lower())))) for i, (name, text) in enumerate(templates)]
    out = spark.createDataFrame(rows, "template int, license string, text string, width int")
    out = out.withColumn("shingles", F.array_distinct(let(tokens_of(F.col("text")), lambda t: shingles_of(t, p))))
    return out.filter(F.size("shingles") > 0).select("template", "license", "width", "shingles", F.size("shingles").alias("size"))


def windows(docs: DataFrame, known: list[int], widths: list[int], p: Scan, id_col: str, text_col: str) -> DataFrame:
    """id, width, start, shingles: the windows of each class that share a shingle with any template; the others hold none."""
    any_ = F.array(*(F.lit(x).cast("long") for x in known))
    whole = docs.select(F.col(id_col).alias("id"), let(tokens_of(F.col(text_col)), lambda t: shingles_of(t, p)).alias("all"))

    def of_width(every: Column, w: int) -> Column:
        starts = F.sequence(F.lit(0), F.size(every) - 1, F.lit(w))
        each = F.transform(starts, lambda s: F.struct(F.lit(w).alias("width"), s.alias("start"), F.slice(every, s + 1, F.lit(2 * w - p.shingle + 1)).alias("shingles")))
        return F.filter(each, lambda x: F.arrays_overlap(x["shingles"], any_))

    def cut(every: Column) -> Column:
        return F.concat(*(of_width(every, w) for w in widths))

    none = F.array().cast("array<struct<width:int,start:int,shingles:array<bigint>>>")
    found = whole.select("id", let(F.col("all"), lambda every: F.when(F.arrays_overlap(every, any_), cut(every)).otherwise(none)).alias("windows"))
    return found.select("id", F.inline("windows"))


def licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, params: Scan | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, license, containment: the licenses of each document, with the best share of a template that a window holds.

    Null, empty or short texts hold none and give no row; rows that repeat an id are one
    document.  Other columns are not read.
    """
    p = params or Scan()
    spark = docs.sparkSession
    table = template_table(spark, templates, p)
    rows = table.select("width", "shingles").collect()  # the list that was given
    known, widths = sorted({x for r in rows for x in r["shingles"]}), sorted({r["width"] for r in rows})
    if not rows:
        return docs.select(F.col(id_col), F.lit("").alias("license"), F.lit(0.0).alias("containment")).limit(0)
    found = windows(docs, known, widths, p, id_col, text_col)
    banded = found.withColumn("shingles", F.array_distinct("shingles")).select("id", "width", "start", "shingles", F.posexplode(minima(F.col("shingles"), p)).alias("band", "value"))
    keys = table.select("template", "width", F.posexplode(minima(F.col("shingles"), p)).alias("band", "value"))
    # the templates are a list in memory, bands() rows each
    met = banded.join(F.broadcast(keys), ["width", "band", "value"]).select("id", "width", "start", "shingles", "template").distinct()
    full = met.join(F.broadcast(table.select("template", "license", "size", F.col("shingles").alias("own"))), "template")
    full = full.withColumn("containment", F.size(F.array_intersect("shingles", "own")) / F.col("size")).filter(F.col("containment") >= p.held)
    return full.groupBy(F.col("id").alias(id_col), "license").agg(F.max("containment").alias("containment"))
