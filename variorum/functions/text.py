"""Column functions for folding, tokenising and describing text.

All of them are compositions of Spark built-ins, so they stay inside the JVM.
Java's ``\\w`` is ASCII; where the contract is "letter, digit or underscore in
any script" the class is spelled out as ``[\\p{L}\\p{N}_]``.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from variorum.params import DEFAULT

WORD = r"[\p{L}\p{N}_]"
NON_ASCII = r"[^\x00-\x7F]"
WS = r"(?U)\s+"
PAGE_NUMBER_RE = r"\[Page\s+(\d+)"
LINEBREAK_RE = rf"(?<!{WORD})({WORD}++)-\s+({WORD}+)"
EMPTY_FOLD = "\u0001"  # stands for a token that folds to nothing


def _folding_table(form: str) -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters whose decomposition keeps an ASCII part: 1-to-1 pairs, and expansions."""
    src, dst, multi = [], [], []
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        kept = unicodedata.normalize(form, ch).encode("ascii", "ignore").decode("ascii")
        if len(kept) == 1:
            src.append(ch)
            dst.append(kept)
        elif kept and len(ch) == 1:
            multi.append((ch, kept))
    return "".join(src), "".join(dst), tuple(multi)


def _one_of(chars: str) -> str:
    """One of some characters beyond ASCII, as ranges; a class asks every member in turn, so ASCII, which most text is, is not asked."""
    codes = sorted({ord(c) for c in chars})
    starts = [c for c, before in zip(codes, (-1, *codes)) if c != before + 1]
    ends = [c for c, after in zip(codes, (*codes[1:], -1)) if c != after - 1]
    return rf"(?=[^\x00-\x7F])[{''.join(chr(a) if a == b else f'{chr(a)}-{chr(b)}' for a, b in zip(starts, ends, strict=True))}]"


_NFD_SRC, _NFD_DST, _ = _folding_table("NFD")
_NFKD_SRC, _NFKD_DST, _NFKD_MULTI = _folding_table("NFKD")
_NFKD_LONG = _one_of("".join(s for s, _ in _NFKD_MULTI))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once.

    An expression mentioned inside a lambda is evaluated again for every element;
    bound to a lambda variable it is evaluated once per row.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_accents(c: Column) -> Column:
    """Drop accents and every other non-ASCII character, keep case."""
    folded = F.regexp_replace(F.translate(c, _NFD_SRC, _NFD_DST), NON_ASCII, "")
    return F.when(c.rlike(NON_ASCII), folded).otherwise(c)


def fold(c: Column) -> Column:
    """Lower case, accents dropped, remaining non-ASCII dropped."""
    return strip_accents(F.lower(c))


def fold_tokens(tokens: Column) -> Column:
    """Element-wise N1."""
    return F.transform(tokens, fold)


def fold_keeping_tokens(text: Column) -> Column:
    """N1 over a blank-joined token string; a token that folds to nothing keeps its slot."""
    low = F.lower(text)
    t = F.translate(low, _NFD_SRC, _NFD_DST)
    t = F.regexp_replace(t, r"(?<![^ ])[^\x00-\x7F]+(?![^ ])", EMPTY_FOLD)
    return F.when(low.rlike(NON_ASCII), F.regexp_replace(t, NON_ASCII, "")).otherwise(low)


def fold_words(words: Column) -> Column:
    """N35 for words without blanks, folded as one string."""
    return let(words, lambda ws: F.when(F.size(ws) > 0, F.split(fold(F.array_join(ws, " ")), " ")).otherwise(ws))


def bare_words(words: Column) -> Column:
    """N1 of N5 of every word of a list; words without blanks."""
    stripped = lambda ws: F.split(F.regexp_replace(F.array_join(ws, " "), r"[^\p{L}\p{N}_\s]", ""), " ")
    return let(words, lambda ws: F.when(F.size(ws) > 0, fold_words(stripped(ws))).otherwise(ws))


_EDGES = r"^\p{Punct}+|\p{Punct}+$"
# the same on every word of a blank-joined string
_WORD_EDGES = r"(?<![^ ])\p{Punct}+|\p{Punct}+(?![^ ])"
# characters that fold to something with a blank in it
_BLANKS = _one_of("".join(s for s, d in (*zip(_NFKD_SRC, _NFKD_DST), *_NFKD_MULTI) if " " in d))


def _strong(c: Column, edges: str) -> Column:
    def ascii_only(low: Column) -> Column:
        # one literal, each entry a character followed by what it expands to
        pairs = F.split(F.lit("\u0002".join(s + d for s, d in _NFKD_MULTI)), "\u0002")
        expanded = lambda t: F.aggregate(pairs, t, lambda acc, p: F.replace(acc, F.left(p, F.lit(1)), F.substring(p, 2, 99)))
        long = lambda t: F.when(t.rlike(_NFKD_LONG), expanded(t)).otherwise(t)
        return let(F.translate(low, _NFKD_SRC, _NFKD_DST), lambda t: F.regexp_replace(long(t), NON_ASCII, ""))

    # most words are ASCII already
    folded = let(F.lower(c), lambda low: F.when(low.rlike(NON_ASCII), ascii_only(low)).otherwise(low))
    return F.regexp_replace(F.replace(folded, F.lit("'"), F.lit("")), edges, "")


def fold_strong(c: Column) -> Column:
    """As N1 with compatibility forms expanded, apostrophes and edge punctuation dropped."""
    return _strong(c, _EDGES)


def fold_strong_line(tokens: Column) -> Column:
    """N2 of every word of a list, blank-joined, a word that folds to nothing as ``EMPTY_FOLD``; folded as one string unless a fold has blanks in it."""
    slot = lambda x: F.coalesce(F.nullif(fold_strong(x), F.lit("")), F.lit(EMPTY_FOLD))
    alone = F.array_join(F.transform(tokens, slot), " ")
    # an empty slot is a place between two blanks, or a blank and an end
    whole = lambda line: F.regexp_replace(_strong(line, _WORD_EDGES), "(?<![^ ])(?![^ ])", EMPTY_FOLD)
    return let(F.array_join(tokens, " "), lambda line: F.when(line == "", line).when(line.rlike(_BLANKS), alone).otherwise(whole(line)))


def fold_strong_set(tokens: Column) -> Column:
    """N35 (set form): distinct non-empty N2 values, folded as one string unless a fold has blanks in it."""
    full = lambda values: F.array_distinct(F.filter(values, lambda x: x != ""))
    alone = F.transform(tokens, fold_strong)
    return let(F.array_join(tokens, " "), lambda line: full(F.when(line.rlike(_BLANKS), alone).otherwise(F.split(_strong(line, _WORD_EDGES), " "))))


def ascii_fold_map(c: Column) -> Column:
    """The fixed accent map used for headings."""
    return F.translate(c, "ÓóÁáÚúÉéÍí", "OoAaUuEeIi")


def strip_punct(c: Column) -> Column:
    """Keep word characters and blanks."""
    return F.trim(F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", ""))


def tokens_ws(c: Column) -> Column:
    """Blank-separated tokens, as the reading has them."""
    return F.filter(F.split(c, WS), lambda x: x != "")


def tokens_word(c: Column) -> Column:
    """Lower-case word tokens."""
    return F.regexp_extract_all(F.lower(c), F.lit(rf"{WORD}+"), F.lit(0))


def tokens_latin(c: Column) -> Column:
    """Lower-case Latin tokens with apostrophes and hyphens (duplicate detection)."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-zA-ZÀ-ÿ'’-]+"), F.lit(0))


def line_words(line: Column, bracket: int = 120) -> Column:
    """ASCII words of one line after removing bracketed notes and heading marks."""
    t = F.regexp_replace(F.trim(line), rf"\[[^\]]{{0,{bracket}}}\]", " ")
    t = F.regexp_replace(t, r"^#+\s*", "")
    t = strip_accents(F.regexp_replace(t, "[—–]", " "))
    return F.regexp_extract_all(F.lower(t), F.lit(r"\b[a-z']+\b"), F.lit(0))


def tokens_ascii(text: Column, noise: str, bracket: int = 120) -> Column:
    """N11 + P5: noise lines dropped, then the words of every remaining line in order.

    As ``line_words`` of every line, but for all lines at once: no match goes over a line's end,
    and heading marks are no part of a word and need not go first.
    """
    lines = F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x))
    kept = F.filter(lines, lambda x: (x != "") & ~x.rlike(noise))
    t = F.regexp_replace(F.array_join(kept, "\n"), rf"\[[^\]\n]{{0,{bracket}}}\]", " ")
    folded = let(t, lambda x: F.when(x.rlike(NON_ASCII), F.regexp_replace(F.translate(x, "—–" + _NFD_SRC, "  " + _NFD_DST), NON_ASCII, "")).otherwise(x))
    return F.regexp_extract_all(F.lower(folded), F.lit(r"\b[a-z']+\b"), F.lit(0))


def words_no_punct(c: Column) -> Column:
    """Punctuation removed, split, folded."""
    return fold_tokens(tokens_ws(F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", "")))


def normalize_quotes(c: Column) -> Column:
    """N7, quotes."""
    return F.regexp_replace(F.regexp_replace(c, "['‘’ʼ`´]", "'"), '["“”„«»]', '"')


def normalize_ellipsis(c: Column) -> Column:
    """N7, ellipses."""
    return F.regexp_replace(F.replace(c, F.lit("…"), F.lit("...")), r"\.\s*\.\s*\.", "...")


def normalize_dashes(c: Column) -> Column:
    """N7, dashes."""
    return F.regexp_replace(c, "[–—‒―]", "--")


def normalize_format(c: Column) -> Column:
    """N7, all three."""
    return normalize_dashes(normalize_ellipsis(normalize_quotes(c)))


def collapse_linebreaks(c: Column) -> Column:
    """N8: 'left- right' becomes 'leftright'."""
    return F.regexp_replace(c, LINEBREAK_RE, "$1$2")


def repair_intraline(c: Column) -> Column:
    """Hyphen repair between lower-case letters inside a line."""
    return F.regexp_replace(c, "([a-záéíóúüñ])- ([a-záéíóúüñ])", "$1$2")


def split_words(q: Column, m: Column) -> Column:
    """(split, joined) pairs whose joined form the other witness confirms, first seen wins."""

    def side(own: Column, other: Column) -> Column:
        found = F.arrays_zip(
            F.regexp_extract_all(own, F.lit(LINEBREAK_RE), F.lit(0)).alias("split"),
            F.regexp_extract_all(own, F.lit(LINEBREAK_RE), F.lit(1)).alias("l"),
            F.regexp_extract_all(own, F.lit(LINEBREAK_RE), F.lit(2)).alias("r"),
        )
        words = fold_tokens(tokens_ws(collapse_linebreaks(other)))
        pairs = F.transform(found, lambda p: F.struct(p["split"].alias("split"), F.concat(p["l"], p["r"]).alias("joined")))
        return let(words, lambda ws: F.filter(pairs, lambda p: F.array_contains(ws, fold(p["joined"]))))

    return F.array_distinct(F.concat(side(q, m), side(m, q)))


def page_numbers(c: Column) -> Column:
    """Page numbers named in a unit, in order; one too long for a page number is null."""
    return F.transform(F.regexp_extract_all(c, F.lit(PAGE_NUMBER_RE), F.lit(1)), lambda x: x.try_cast("int"))


def page_label(pages: Column) -> Column:
    """N13: 'pp. min–max'."""
    lo, hi = F.array_min(pages).cast("string"), F.array_max(pages).cast("string")
    return F.when(F.size(pages) > 0, F.concat(F.lit("pp. "), lo, F.lit("–"), hi)).otherwise("p. ?")


def edit_distance(a: Column, b: Column) -> Column:
    """Case-insensitive Levenshtein distance."""
    return F.levenshtein(F.lower(a), F.lower(b))


def overlap_similarity(a: Column, b: Column) -> Column:
    """Shared distinct tokens over the larger distinct set (inputs already distinct)."""
    big = F.greatest(F.size(a), F.size(b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / big)


def recall_precision(a: Column, b: Column) -> Column:
    """struct(recall, precision) of two distinct token sets."""
    inter = F.size(F.array_intersect(a, b))
    return F.struct(
        F.when(F.size(a) > 0, inter / F.size(a)).otherwise(0.0).alias("recall"),
        F.when(F.size(b) > 0, inter / F.size(b)).otherwise(0.0).alias("precision"),
    )


def sig_words(text: Column, min_len: int = DEFAULT.drift_min_len) -> Column:
    """Distinct folded words of a useful length."""
    stripped = F.split(F.regexp_replace(text, r"(?U)[^\p{L}\p{N}_\s]", ""), WS)
    return F.array_distinct(fold_words(F.filter(stripped, lambda w: (w != "") & (F.length(w) >= min_len))))


def share(part: Column, whole: Column) -> Column:
    """Part of whole as a double, null when the whole is empty."""
    return F.when(whole > 0, part / whole)


def position_pct(i: Column, total: Column) -> Column:
    """Rounded percentage through the text."""
    return F.when(total > 0, F.bround(100 * i / total, 0).cast("int"))


def positions(text: Column, phrase: str) -> Column:
    """0-based places of all hits of a phrase, from the left and without overlap."""

    def places(parts: Column) -> Column:
        # a running sum of the parts' lengths, in one pass
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda acc, p: F.struct((acc["at"] + F.length(p) + len(phrase)).alias("at"), F.concat(acc["out"], F.array(acc["at"] + F.length(p))).alias("out"))
        return F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), start, step)["out"]

    return let(F.split(text, re.escape(phrase)), places)


def excerpt(text: Column, start: Column, end: Column, ctx: int = DEFAULT.excerpt_context) -> Column:
    """Text around [start, end) with ellipses where it was cut (0-based offsets)."""
    lo = F.greatest(F.lit(0), start - ctx)
    hi = F.least(F.length(text), end + ctx)
    body = F.trim(F.replace(text.substr(lo + 1, hi - lo), F.lit("\n"), F.lit(" ")))
    return F.concat(F.when(lo > 0, "…").otherwise(""), body, F.when(hi < F.length(text), "…").otherwise(""))


def cut(words: Column, lo: Column, hi: Column) -> Column:
    """words[lo:hi], picked by index.

    ``slice`` copies the whole array each time it runs, which is quadratic when a
    row is cut into many pieces.
    """
    picked = F.transform(F.sequence(lo, F.greatest(hi - 1, lo)), lambda i: F.get(words, i))
    return F.when(hi > lo, picked).otherwise(F.array().cast("array<string>"))


def left_context(tokens: Column, i: Column, k: int) -> Column:
    """Up to k tokens before index i."""
    return F.array_join(cut(tokens, F.greatest(i - k, F.lit(0)), i), " ")


def right_context(tokens: Column, i: Column, k: int) -> Column:
    """Up to k tokens from index i on."""
    return F.array_join(cut(tokens, i, F.least(i + k, F.size(tokens))), " ")


def wide_context(tokens: Column, target: Column, window: int = DEFAULT.page_context, folded: Column | None = None) -> Column:
    """struct(before, after) around the first token of the target, else around the middle.

    ``folded`` may hold the tokens' folded forms when many targets share them.
    """
    half = window // 2
    if folded is None:
        folded = F.transform(tokens, lambda w: fold(strip_punct(w)))

    def excerpt_of(ts: Column, fs: Column) -> Column:
        places = F.filter(F.transform(sig_words(target, 3), lambda w: F.array_position(fs, w).cast("int")), lambda i: i > 0)
        anchor_of = F.coalesce(F.array_min(places) - 1, F.floor(F.size(ts) / 2).cast("int"))
        return let(
            anchor_of,
            lambda at: F.struct(
                F.array_join(cut(ts, F.greatest(F.lit(0), at - half), at), " ").alias("before"),
                F.array_join(cut(ts, at, F.least(F.size(ts), at + half)), " ").alias("after"),
            ),
        )

    return let(F.struct(tokens.alias("t"), folded.alias("f")), lambda x: excerpt_of(x["t"], x["f"]))


def html_escape(c: Column, attribute: bool = False) -> Column:
    """N23."""
    t = F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    if attribute:
        t = F.replace(F.replace(t, F.lit('"'), F.lit("&quot;")), F.lit("'"), F.lit("&#39;"))
    return t


def parse_verdicts(raw: Column, n: Column) -> Column:
    """N verdict letters from 'N:X' pairs (last wins), else from bare letters in order."""
    pair = r"(\d+)\s*[:.\)]\s*([ABCU])"
    nums = F.transform(F.regexp_extract_all(raw, F.lit(pair), F.lit(1)), lambda x: x.try_cast("int"))
    pairs = F.arrays_zip(nums.alias("k"), F.regexp_extract_all(raw, F.lit(pair), F.lit(2)).alias("v"))
    bare = F.regexp_extract_all(raw, F.lit(r"(?U)\b([ABCU])\b"), F.lit(1))
    slots = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))

    def by_number(ps: Column, i: Column) -> Column:
        return F.coalesce(F.try_element_at(F.filter(ps, lambda p: p["k"] == i), F.lit(-1))["v"], F.lit("U"))

    numbered = let(pairs, lambda ps: F.transform(slots, lambda i: by_number(ps, i)))
    placed = let(bare, lambda bs: F.transform(slots, lambda i: F.coalesce(F.get(bs, i - 1), F.lit("U"))))
    return F.when(F.size(nums) > 0, numbered).otherwise(placed)


def display_clean(c: Column, titles: tuple[str, ...]) -> Column:
    """Page markers (with a following title), bare titles and bracketed dots removed."""
    names = "|".join(t.replace(" ", r"\s+") for t in titles) or r"(?!)"
    t = F.regexp_replace(c, rf"(?i)\[Page(?:\s+LEFT|\s+RIGHT)?\s*\d*\]\s*(?:{names})?\s*", "")
    t = F.regexp_replace(t, rf"(?:{names})", "")
    t = F.regexp_replace(t, r"\[\s*\.{2,}\s*\]|\[\s*…\s*\]", "[illegible]")
    return F.trim(F.regexp_replace(t, "  +", " "))


def anchor_slug(heading: Column) -> Column:
    """Link anchor of a heading."""
    return F.concat(F.lit("chap-"), F.translate(F.replace(F.lower(heading), F.lit(" "), F.lit("-")), "óáéíú", "oaeiu"))


def is_right_page(page: Column) -> Column:
    """Odd pages are right-hand pages."""
    return page % 2 == 1


def span_id(book: Column, unit_no: Column, ordinal: Column) -> Column:
    """N28."""
    safe = F.translate(book.cast("string"), ".-", "__")
    return F.concat(safe, F.lit("_s"), unit_no.cast("string"), F.lit("_"), ordinal.cast("string"))


def highlight(text: Column, words: Column) -> Column:
    """Tokens whose folded form is a drift word, wrapped in asterisks."""
    def mark(ws: Column, w: Column) -> Column:
        return F.when(F.array_contains(ws, fold(strip_punct(w))), F.concat(F.lit("*"), w, F.lit("*"))).otherwise(w)

    return F.array_join(let(words, lambda ws: F.transform(tokens_ws(text), lambda w: mark(ws, w))), " ")


def paragraphs(c: Column) -> Column:
    """Blank-line separated paragraphs, trimmed, empties dropped."""
    parts = F.transform(F.split(c, r"\n\s*\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.filter(parts, lambda x: x != "")


def blocks_text(blocks: Column) -> Column:
    """Paragraph texts of a page's block array."""
    return F.array_join(F.transform(F.filter(blocks, lambda b: b["type"] == "paragraph"), lambda b: F.coalesce(b["text"], F.lit(""))), " ")


def block_struct(kind: Column, text: Column, book: Column, unit_no: Column) -> Column:
    """Block record without empty fields; only failed blocks keep their provenance."""
    failed = kind == "needs_review"
    return F.struct(
        kind.alias("type"),
        F.nullif(text, F.lit("")).alias("text"),
        F.when(failed, book.cast("string")).alias("source_pdf"),
        F.when(failed, unit_no.cast("int")).alias("spread_number"),
    )


def front_matter(blocks: Column) -> Column:
    """One pseudo page around front-matter blocks, or an empty array."""
    page = F.struct(F.lit("front_matter_page").alias("type"), blocks.alias("content_blocks"))
    return F.when(F.size(blocks) > 0, F.array(page)).otherwise(F.filter(F.array(page), lambda _: F.lit(False)))


def clean_block(c: Column, titles: tuple[str, ...] = (), authors: tuple[str, ...] = (), strict: bool = True) -> Column:
    """N36 + P6: structural markers replaced by a blank.

    ``strict`` removes an author line only when it holds nothing else; otherwise
    any line that starts so is removed.
    """
    tail = r"[ \t]*$" if strict else r".*$"
    alts = [
        r"<<< SPREAD_(?:START|END)[^>]*>>>",
        r"^#.*$",
        r"^\[Page\s+\d+[^\]]*\]\s*$",
        r"^\[section break\]\s*$",
        *[rf"^{t}\s*$" for t in titles],
        *[rf"^{a}{tail}" for a in authors],
    ]
    return F.regexp_replace(c, "(?mi)" + "|".join(alts), " ")


def reading_words(c: Column, **kw) -> Column:
    """Tokens of a reading without its structural markers."""
    return tokens_ws(clean_block(c, **kw))
