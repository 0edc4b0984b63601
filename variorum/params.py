"""Thresholds and vocabularies, in one immutable place."""

from __future__ import annotations

from dataclasses import dataclass

# fixed values: phrases by which a reader declines to transcribe a unit
REFUSAL_PHRASES = (
    "i'm not able to transcribe",
    "i am not able to transcribe",
    "cannot transcribe",
    "i'm unable to transcribe",
    "i cannot reproduce",
    "copyrighted",
    "copyright infringement",
    "i'd rather not",
    "i would rather not",
    "reproducing substantial",
    "i can help by summarizing",
    "i can summarize",
    "i'm happy to help in other ways",
)

# fixed values: function words whose one-for-one swap is noise in a content diff
FUNCTION_WORDS = ("a", "the", "an", "of", "in", "to", "and", "is", "it", "i")

# fixed values: difference categories, most severe first
CATEGORIES = (
    "phrase, major divergence",
    "different word (single)",
    "phrase, multiple words differ",
    "phrase, one word differs",
    "insertion (M only)",
    "insertion (M phrase)",
    "deletion (Q only)",
    "deletion (Q phrase)",
    "phrase, minor length diff",
    "spelling variant (1–2 edits)",
    "accent/diacritic",
    "punctuation only",
)
HIGH_SEVERITY = CATEGORIES[:3]

# fixed values: majority classes of a three-way reading
CLASSES = ("Q=M≠C", "Q≠M≠C", "Q=C≠M", "M=C≠Q", "Q≠M (C n/a)")

# fixed values: status domain of a page-keyed two-way comparison
PAGE_STATUSES = (
    "good_match",
    "minor_divergence",
    "significant_divergence",
    "one_side_missing",
    "orphan_t1_only",
    "orphan_t2_only",
)

# fixed values: verdict letters of an adjudicator
VERDICTS = ("A", "B", "C", "U", "ERROR")


@dataclass(frozen=True)
class Chapter:
    """One row of the chapter dimension."""

    slug: str
    heading: str


@dataclass(frozen=True)
class Params:
    # page-keyed comparison
    good_match: float = 0.92
    minor_divergence: float = 0.70
    # bucketed agreement
    bucket_pages: int = 50
    flag_below: float = 0.80
    # chapter and running-header matching
    chapter_cutoff: float = 0.85
    header_cutoff: float = 0.80
    max_bare_page: int = 500
    # span context
    context: int = 7
    report_context: int = 35
    mark_context: int = 12
    content_context: int = 12
    page_context: int = 120
    drift_min_len: int = 3
    # anchors
    anchor_back: int = 19
    anchor_forward: int = 20
    inspan_back: int = 9
    inspan_forward: int = 10
    # correction rules
    min_phrase_words: int = 2
    single_max_m_words: int = 5
    # base transplant and fallback
    min_confidence: float = 0.5
    min_unit_words: int = 5
    min_block_words: int = 2
    min_length_ratio: float = 0.7
    max_length_ratio: float = 1.5
    min_verify: float = 0.70
    min_recall: float = 0.45
    min_precision: float = 0.18
    # deduplication
    overlap_min_words: int = 5
    overlap_max_head: int = 80
    overlap_tail_reach: int = 120
    overlap_sample: int = 400
    overlap_ratio_window: int = 200
    overlap_min_ratio: float = 0.30
    block_min_words: int = 15
    block_min_sim: float = 0.72
    lookback: int = 3
    # repetition
    loop_ngram: int = 8
    loop_count: int = 3
    repeat_ngram: int = 10
    repeat_distance: int = 5
    # quality report
    excerpt_context: int = 40
    fragment_tolerance: int = 5
    min_smoke_chars: int = 30
    # titles stripped as running headers, and prefixes of author/publisher lines
    running_titles: tuple[str, ...] = ("COLLECTED WITNESSES",)
    author_prefixes: tuple[str, ...] = ("EDITED BY",)
    chapters: tuple[Chapter, ...] = ()


DEFAULT = Params()
