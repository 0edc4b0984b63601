"""Flat texts with page markers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKER = r"\[Page\s+\d+[^\]\n]*\]"


def segments(text: Column) -> Column:
    """Array of (page_number, inferred, body) between consecutive markers at line starts.

    The marker is moved behind a separator, so one ``split`` yields marker and
    body together; text before the first marker belongs to no page.
    """
    cut = F.split(F.regexp_replace(text, rf"(?m)^({MARKER})", "\u0002$1"), "\u0002")
    tail = F.slice(cut, 2, F.greatest(F.size(cut) - 1, F.lit(0)))
    return F.transform(
        tail,
        lambda s: F.struct(
            F.regexp_extract(s, r"^\[Page\s+(\d+)", 1).try_cast("int").alias("page_number"),
            F.regexp_extract(s, rf"^{MARKER}", 0).contains("(inferred)").alias("inferred"),
            F.btrim(F.regexp_replace(s, rf"^{MARKER}", ""), F.lit(" \n\r\t")).alias("text"),
        ),
    )


def pages(texts: DataFrame, text: str, keys: Sequence[str], marker: str = "top") -> DataFrame:
    """One row per page of every text, later repeats of a page number win.

    ``marker`` says whether a page's marker stands above or below its body; with
    'bottom' each body belongs to the marker that follows it.
    """
    if marker == "top":
        parts = texts.select(*keys, F.posexplode(segments(F.col(text))).alias("pos", "p"))
    else:
        turned = F.transform(
            F.filter(_bottom(F.col(text)), lambda s: s.rlike(rf"{MARKER}$")),
            lambda s: F.struct(
                F.regexp_extract(s, r"\[Page\s+(\d+)[^\]\n]*\]$", 1).try_cast("int").alias("page_number"),
                F.regexp_extract(s, rf"{MARKER}$", 0).contains("(inferred)").alias("inferred"),
                F.btrim(F.regexp_replace(s, rf"{MARKER}$", ""), F.lit(" \n\r\t")).alias("text"),
            ),
        )
        parts = texts.select(*keys, F.posexplode(turned).alias("pos", "p"))
    return parts.groupBy(*keys, F.col("p.page_number").alias("page_number")).agg(
        F.max_by(F.struct("p.inferred", "p.text"), "pos").alias("v"), F.count("*").alias("n_markers")
    ).select(*keys, "page_number", "v.inferred", "v.text", "n_markers")


def _bottom(text: Column) -> Column:
    return F.split(F.regexp_replace(text, rf"(?m)^({MARKER})", "$1\u0002"), "\u0002")


def render(page: Column, inferred: Column, blocks: Column) -> Column:
    """A page of typed blocks as clean text."""
    nl = F.lit("\n")

    def one(b: Column) -> Column:
        t = F.coalesce(b["text"], F.lit(""))
        return (
            F.when(b["type"] == "chapter_heading", F.concat(nl, t, nl))
            .when(b["type"] == "section_number", t)
            .when(b["type"] == "section_break", F.lit("\n[section break]\n"))
            .when(b["type"] == "paragraph", F.concat(t, nl))
            .when(b["type"] == "italic_block", F.concat(F.lit("_"), t, F.lit("_\n")))
            .when(
                b["type"] == "needs_review",
                F.format_string("\n[NEEDS_REVIEW: %s spread %d — manual transcription required]\n", b["source_pdf"], b["spread_number"]),
            )
        )

    head = F.concat(F.lit("[Page "), page.cast("string"), F.when(inferred, " (inferred)").otherwise(""), F.lit("]"))
    body = F.filter(F.transform(blocks, one), lambda x: x.isNotNull())
    return F.array_join(F.concat(F.array(head), body, F.array(F.lit(""))), "\n")
