"""Row predicates and classifications (P rows of the survey) as Columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from variorum.functions import text as T
from variorum.params import DEFAULT, HIGH_SEVERITY, REFUSAL_PHRASES, Params

FAILED_MARK = r"\[(?:NEEDS_REVIEW|EXTRACTION_ERROR)"
ERROR_MARK = r"\[[A-Z]+_ERROR"

# fixed values: pattern of bracketed notes that describe the photograph, not the text
IMAGE_OPENERS = r"(?i)^\[(?:The |This |Left|Right|Both |Blank|No |I |A |An )"
IMAGE_WORDS = r"(?i)\b(?:blank|faint|washed.out|unclear|cannot|unable to|transcrib|not.visible|illegible)\b"
# fixed values: spellings of a section break
SECTION_BREAK = r"(?i)^\[?(section break|decorative break|ornament(?:al)? break?|small square|ornament|divider)\]?$"
# fixed values: print codes that are not text
GARBLED = r"^(?:\d{3,}|[A-Z]{2,4}\d{2}[\s\d\-a-z]+|[A-Z]{2,6}(?:\s+\d[\d\-]*)+|[A-Z]{3,6})$"
# fixed values: ornament described as text
ORNAMENT = (
    r"(?i)^\s*(?:[\[◆*•\-]*\s*(?:decorative|ornamental|ornament)\s*(?:symbol|break|ornament|element)?\s*[\]]*"
    r"|◆|[*]{3}|\*\s*\*\s*\*)\s*$"
)
# fixed values: bracketed notes and rules that are never body text
NOTE_LINES = (r"\[Page shows", r"\[Page is blank", r"\[Page -", r"\[Left page", r"\[Right page",
              r"\[EXTRACTION FAILED", r"\[NEEDS_REVIEW")


def is_refusal(c: Column) -> Column:
    """The reading declines instead of transcribing."""
    return F.lower(c).rlike("|".join(re.escape(p) for p in REFUSAL_PHRASES))


def unit_failed(content: Column) -> Column:
    """The first line carries a failure marker."""
    return F.get(F.split(content, r"\r?\n"), F.lit(0)).rlike(FAILED_MARK)


def failed_unit_numbers(content: Column) -> Column:
    """Units named by failure markers."""
    return F.transform(F.regexp_extract_all(content, F.lit(r"\[NEEDS_REVIEW: .+? spread (\d+)"), F.lit(1)), lambda x: x.try_cast("int"))


def noise_pattern(kind: str, params: Params = DEFAULT) -> str:
    """P5: the three noise vocabularies: first generation, second generation, witness logs."""
    titles = [rf"{t}\s*$" for t in params.running_titles]
    if kind == "first":
        alts = ["━+", "═+", r"#\s", r"Source:\s", *titles, *params.author_prefixes, *NOTE_LINES, "I appreciate your detailed"]
    elif kind == "second":
        alts = [r"\[Page\s+\d+", "={3,}", r"\[Assembly note", *titles, *params.author_prefixes]
    elif kind == "witness":
        alts = [r"#\s", "<<< SPREAD", "={3,}", *titles, *params.author_prefixes, *NOTE_LINES, ERROR_MARK, r"\[Assembly note"]
    else:
        raise ValueError(kind)
    return "(?i)^(?:" + "|".join(alts) + ")"


def strip_headers(c: Column, titles: tuple[str, ...]) -> Column:
    """Running-title lines."""
    return F.regexp_replace(c, "(?mi)" + "|".join(rf"^{t}\s*$" for t in titles), "")


def strip_section_breaks(c: Column) -> Column:
    """Section-break lines."""
    return F.regexp_replace(c, r"(?mi)^\[section break\]\s*$", "")


def strip_allcaps(c: Column) -> Column:
    """Standalone all-capitals lines."""
    return F.regexp_replace(c, r"(?m)^[A-ZÁÉÍÓÚÜÑ][A-ZÁÉÍÓÚÜÑ\s\-]{3,}$", "")


def is_bare_number(line: Column, params: Params = DEFAULT) -> Column:
    """P10: a line that is only a printed page number."""
    return line.rlike(r"^\d{1,4}$") & line.try_cast("int").between(1, params.max_bare_page)


def is_section_break(line: Column) -> Column:
    """P11."""
    return line.rlike(SECTION_BREAK)


def is_roman(line: Column) -> Column:
    """P12."""
    return line.rlike("^[IVX]+$")


def is_image_note(line: Column) -> Column:
    """Bracketed description of the photograph."""
    return (
        line.startswith("[")
        & ~line.isin("[...]", "[section break]")
        & ~line.rlike(FAILED_MARK)
        & (
            (line.startswith("[Page ") & ~line.rlike(r"^\[Page\s+\d+\]$"))
            | line.rlike(IMAGE_OPENERS)
            | line.rlike(IMAGE_WORDS)
        )
    )


def strip_heading_marks(line: Column) -> Column:
    """Markdown heading prefix."""
    return F.when(line.startswith("#"), F.trim(F.regexp_replace(line, "^#+", ""))).otherwise(line)


def is_side_label(line: Column) -> Column:
    """P14: 'LEFT PAGE:' and the like."""
    return line.rlike(r"(?i)^(?:LEFT|RIGHT)\s+PAGE\s*:?$")


def is_italic(line: Column) -> Column:
    """P15."""
    return line.rlike("^[*_]")


def italic_text(line: Column) -> Column:
    """Text without its marks."""
    return F.regexp_replace(line, r"^[*_]+|[*_]+$", "")


def is_gutter_gap(line: Column) -> Column:
    """P16."""
    return line == "[...]"


def line_kind(line: Column, chapter: Column, running_header: Column, front: Column, params: Params = DEFAULT) -> Column:
    """First matching rule decides; ``line`` is trimmed and free of heading marks.

    ``chapter`` is the matched slug or null, ``running_header`` a boolean,
    ``front`` marks front-matter units, where neither applies.
    """
    return (
        F.when(line == "", "blank")
        .when(is_side_label(line), "side_label")
        .when(is_image_note(line), "image_note")
        .when(line.rlike(r"^\[Page\s+\d+\]$"), "page_marker")
        .when(~front & chapter.isNotNull(), "chapter_heading")
        .when(is_bare_number(line, params), "bare_number")
        .when(~front & running_header, "running_header")
        .when(is_section_break(line), "section_break")
        .when(is_roman(line), "section_number")
        .when(is_italic(line), "italic_block")
        .when(line.rlike(FAILED_MARK), "needs_review")
        .when(is_gutter_gap(line), "gutter_gap")
        .otherwise("text")
    )


# kinds that end the running paragraph, and kinds that become a block of their own
FLUSHING = ("blank", "page_marker", "chapter_heading", "bare_number", "section_break", "section_number",
            "italic_block", "needs_review")
BLOCK_KINDS = ("chapter_heading", "section_break", "section_number", "italic_block", "needs_review")


def has_page_marker(content: Column) -> Column:
    """P18 input: the unit has a numeric page marker at a line start."""
    return content.rlike(r"(?m)^\[Page\s+\d+\]")


def ends_mid_sentence(t: Column) -> Column:
    """The last character is lower case or a hyphen."""
    return t.rlike(r"[\p{Ll}-]\s*$")


def starts_mid_sentence(t: Column) -> Column:
    """The first character is lower case."""
    return t.rlike(r"^\s*\p{Ll}")


def is_garbled(t: Column) -> Column:
    """P20."""
    return F.trim(t).rlike(GARBLED)


def page_status(content: Column) -> Column:
    """P21."""
    return F.when(content.rlike(r"\[EXTRACTION FAILED|\[NEEDS_REVIEW|\[NEEDS MANUAL TRANSCRIPTION"), "missing").otherwise("present")


def pair_status(in1: Column, in2: Column, s1: Column, s2: Column, n1: Column, n2: Column, ratio: Column,
                params: Params = DEFAULT) -> Column:
    """Status of a page present in one or both generations."""
    return (
        F.when(~in1, "orphan_t2_only")
        .when(~in2, "orphan_t1_only")
        .when((s1 == "missing") | (s2 == "missing"), "one_side_missing")
        .when((n1 == 0) & (n2 == 0), "good_match")
        .when((n1 == 0) | (n2 == 0), "significant_divergence")
        .when(ratio >= params.good_match, "good_match")
        .when(ratio >= params.minor_divergence, "minor_divergence")
        .otherwise("significant_divergence")
    )


def majority_class(q: Column, m: Column, c: Column) -> Column:
    """Which of three readings agree; a null or empty third reading is 'n/a'."""
    folds = F.struct(T.fold(q).alias("q"), T.fold(m).alias("m"), T.fold(c).alias("c"))
    votes = lambda n: (
        F.when(n["q"] == n["m"], "Q=M")
        .when(n["c"] == n["q"], "Q=C≠M")
        .when(n["c"] == n["m"], "M=C≠Q")
        .otherwise("Q≠M≠C")
    )
    return F.when(c.isNull() | (c == ""), "Q≠M (C n/a)").otherwise(T.let(folds, votes))


def vote_by_position(q: Column, m: Column, c: Column) -> Column:
    """P24 over already aligned tokens: every class including full agreement and 'base differs'."""
    return (
        F.when((q == m) & (m == c), "Q=M=C")
        .when(q == m, "Q=M≠C")
        .when(c == q, "Q=C≠M")
        .when(c == m, "M=C≠Q")
        .otherwise("Q≠M≠C")
    )


def has_linebreak(c: Column) -> Column:
    """P37."""
    return c.rlike(T.LINEBREAK_RE)


def is_linebreak_only(q: Column, m: Column) -> Column:
    """P25: the readings differ only by a word split at a line end."""
    same = T.words_no_punct(T.collapse_linebreaks(q)) == T.words_no_punct(T.collapse_linebreaks(m))
    return (has_linebreak(q) | has_linebreak(m)) & same


def is_format_only(q: Column, m: Column) -> Column:
    """The readings differ only in quotes, ellipses or dashes."""
    broken = (has_linebreak(q) | has_linebreak(m)) & (T.fold(T.collapse_linebreaks(q)) == T.fold(T.collapse_linebreaks(m)))
    return (q != m) & ~broken & (T.normalize_format(q) == T.normalize_format(m))


def difference_category(q: Column, m: Column, mode: str = "report") -> Column:
    """One of twelve categories.

    The two callers test the one-word case and the punctuation-only case in
    opposite order; ``mode`` is 'report' or 'mark'.
    """
    known = F.struct(T.tokens_ws(q).alias("qw"), T.tokens_ws(m).alias("mw"), T.strip_punct(q).alias("sq"), T.strip_punct(m).alias("sm"))

    def category(x: Column) -> Column:
        qw, mw, sq, sm = x["qw"], x["mw"], x["sq"], x["sm"]
        nq, nm = F.size(qw), F.size(mw)
        dist = T.edit_distance(sq, sm)
        diffs = F.size(F.filter(F.zip_with(qw, mw, lambda a, b: T.fold(a) != T.fold(b)), lambda d: d))
        word = (
            F.when(dist == 0, "punctuation only")
            .when(dist <= 2, "spelling variant (1–2 edits)")
            .when(T.fold(sq) == T.fold(sm), "accent/diacritic")
            .otherwise("different word (single)")
        )
        one_word = [((nq == 1) & (nm == 1), word)]
        punct = [(sq == "", F.lit("insertion (M phrase)")), (sm == "", F.lit("deletion (Q phrase)"))]
        ordered = one_word + punct if mode == "report" else punct + one_word
        out = F.when(nq == 0, "insertion (M only)").when(nm == 0, "deletion (Q only)")
        for cond, value in ordered:
            out = out.when(cond, value)
        return (
            out.when(F.lower(sq) == F.lower(sm), "punctuation only")
            .when(T.fold(q) == T.fold(m), "accent/diacritic")
            .when((nq == nm) & (diffs == 1), "phrase, one word differs")
            .when(nq == nm, "phrase, multiple words differ")
            .when(F.abs(nq - nm) <= 2, "phrase, minor length diff")
            .otherwise("phrase, major divergence")
        )

    return T.let(known, category)


def is_high_severity(category: Column) -> Column:
    """P28."""
    return category.isin(*HIGH_SEVERITY)


def fourth_verdict(q: Column, m: Column, c: Column, o: Column) -> Column:
    """What a fourth reading decides about a three-way disagreement."""
    qn, mn, on = T.fold(q), T.fold(m), T.fold(o)
    cn = T.fold(c)
    return (
        F.when(o.isNull() | (o == ""), "skip_na")
        .when((on == qn) & (on != mn), "apply")
        .when((on == mn) & (on != qn), "keep_m")
        .when(c.isNotNull() & (on == cn), "keep_c")
        .otherwise("skip_none")
    )


def alignment_reject(n_ref: Column, n_block: Column, conf: Column, n_repl: Column, verify: Column, hyphen: Column,
                     params: Params = DEFAULT) -> Column:
    """P30 + P35: why an alignment may not replace a block; null when it may."""
    ratio = n_repl / F.greatest(F.lit(1), n_block)
    return (
        F.when(n_block < params.min_block_words, "too_short")
        .when(n_ref == 0, "no_reference")
        .when(conf < params.min_confidence, "confidence")
        .when(~ratio.between(params.min_length_ratio, params.max_length_ratio), "length_ratio")
        .when(verify < params.min_verify, "verify")
        .when(hyphen, "linebreak_hyphen")
    )


def ornament_to_break(kind: Column, text: Column) -> Column:
    """Block type after display cleaning; null drops an emptied paragraph."""
    return F.when(kind != "paragraph", kind).when(text == "", F.lit(None)).when(text.rlike(ORNAMENT), "section_break").otherwise(kind)


def score_band(score: Column) -> Column:
    """Display band of an agreement score."""
    return F.when(score < 0.80, "red").when(score < 0.90, "orange").otherwise("green")


def orphan_route(kind: Column, is_front_source: Column, pre_marker: Column) -> Column:
    """Where a block before the first page marker of its unit goes."""
    return (
        F.when(kind == "needs_review", "review_list")
        .when(is_front_source & pre_marker, "front_matter")
        .otherwise("inferred_page")
    )


def word_swap_noise(tag: Column, t1: Column, t2: Column) -> Column:
    """One-for-one replacement of a function word."""
    from variorum.params import FUNCTION_WORDS

    return (tag == "replace") & ~t1.contains(" ") & ~t2.contains(" ") & t1.isin(*FUNCTION_WORDS)


def smoke_ok(content: Column, looped: Column, params: Params = DEFAULT) -> Column:
    """A reading is long enough and does not loop."""
    return (F.length(F.trim(content)) >= params.min_smoke_chars) & ~looped
