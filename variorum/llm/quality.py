"""Quality rules: a threshold table compiled into one projection of built-in functions.

A measure is a count of the text or a ratio of two counts; a rule bounds a measure.  The
table of rules is data: `judge` turns it into one boolean column, so a rule more costs no
pass more.  No user function runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variorum.functions.text import let

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# fixed values: frequent function words of English, German, French and Spanish
STOP_WORDS = (
    "the of and to in is that it for as was with be by on not he his but at are this have from or had an they which one you were her all "
    "der die das und ist in den von zu mit sich des auf für nicht ein eine im dem auch es an als wie bei "
    "le la les de et des en un une est que dans qui pour par sur pas au du se ce il plus ne avec "
    "el los las y del que un una por con no para su al lo como más pero sus se a o"
).split()


@dataclass(frozen=True)
class Rule:
    """The document passes if low <= measure <= high; an absent bound does not hold it."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# percentages are per 100 words or lines
RULES = (
    Rule("words", "n_words", 50, None),
    Rule("repeated_words", "repeat_pct", None, 50),
    Rule("word_length", "mean_word_chars", 2, 12),
    Rule("symbols", "symbol_pct", None, 10),
    Rule("stop_words", "stop_pct", 6, None),
    Rule("repeated_lines", "dup_line_pct", None, 50),
    Rule("marked_words", "marked_pct", None, 30),
)


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _repeat_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, from the array of words."""
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    gram = lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i"))
    grams = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), gram)).otherwise(none)

    def covered(s: Column) -> Column:
        twin = lambda x, p: F.get(s, p - 1)["h"].eqNullSafe(x["h"]) | F.get(s, p + 1)["h"].eqNullSafe(x["h"])
        at = F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))
        step = lambda acc, i: F.struct((i + 3).alias("to"), (acc["n"] + i + 3 - F.greatest(i, acc["to"])).alias("n"))
        return F.aggregate(at, F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")), step, lambda acc: acc["n"])

    return F.transform(F.array(F.sort_array(grams)), covered)[0]


def _counts(text: Column) -> Column:
    """struct of the counts of a text."""

    def by_words(w: Column, lines: Column) -> Column:
        stop = lambda x: F.regexp_replace(F.lower(x), r"[.,;:!?]+$", "").isin(*STOP_WORDS)
        counts = {
            "n_words": F.size(w),
            "word_chars": _without(text, SPACES),
            "n_symbols": F.length(text) - _without(text, SYMBOLS),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": _repeat_words(w),
            "n_stop": F.size(F.filter(w, stop)),
            "n_marked": F.size(F.filter(w, lambda x: x.rlike(r"[!?#*$%&|<>~^]$"))),
        }
        return F.struct(*(v.cast("long").alias(k) for k, v in counts.items()))

    words = F.filter(F.split(text, SPACE), lambda x: x != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    return let(words, lambda w: let(lines, lambda ls: by_words(w, ls)))


def _ratios(c: Column) -> dict[str, Column]:
    pct = lambda a, b: F.coalesce(F.try_divide(100 * c[a], c[b]), F.lit(0.0))
    return {
        "n_words": c["n_words"],
        "repeat_pct": pct("n_repeat_words", "n_words"),
        "mean_word_chars": F.coalesce(F.try_divide(c["word_chars"], c["n_words"]), F.lit(0.0)),
        "symbol_pct": pct("n_symbols", "word_chars"),
        "stop_pct": pct("n_stop", "n_words"),
        "dup_line_pct": pct("n_dup_lines", "n_lines"),
        "marked_pct": pct("n_marked", "n_words"),
    }


def failed(counts: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that a struct of counts breaks, in table order."""
    ratio = _ratios(counts)
    breaks = []
    for r in rules:
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (ratio[r.measure] < r.low)
        if r.high is not None:
            bad = bad | (ratio[r.measure] > r.high)
        breaks.append(F.when(bad, F.lit(r.name)))
    return F.array_compact(F.array(*breaks))


def verdict(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """struct(counts, failed_rules, base_failed, kept) of a text; null counts as empty.

    Text, words and counts are bound inside the expression, so a filter on it costs one evaluation.
    """

    def judged(c: Column) -> Column:
        base = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
        row = lambda bad: F.struct(c.alias("counts"), bad.alias("failed_rules"), base.alias("base_failed"), (~base & (F.size(bad) == 0)).alias("kept"))
        return let(failed(c, rules), row)

    return let(F.coalesce(text.cast("string"), F.lit("")), lambda t: let(_counts(t), judged))


def judge(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with the counts, `failed_rules`, `base_failed` and `kept`.

    A null or blank text has no word and fails the word rule.  Columns of `docs` that bear a
    name of the results are replaced; rows that repeat are judged alike.
    """
    counts = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop", "n_marked")
    names = (*counts, "failed_rules", "base_failed", "kept")
    kept = [c for c in docs.columns if c not in names or c == text_col]
    out = docs.select(*kept, verdict(F.col(text_col), rules).alias("__verdict"))
    return out.select(*kept, *(F.col(f"__verdict.counts.{c}").alias(c) for c in counts), *(F.col(f"__verdict.{c}").alias(c) for c in names[len(counts):]))
