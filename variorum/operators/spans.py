"""Disagreements between readings: from unit tables to classified spans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variorum.functions import align as A
from variorum.functions import predicates as P
from variorum.functions import text as T
from variorum.params import CATEGORIES, DEFAULT, Params

BOOK = ("book",)


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Even out rows before an expensive per-row step.

    An explicit partition count keeps adaptive execution from merging small
    partitions again: bytes are few here, CPU per row is not.  The hash of the
    keys, not the keys, is the partitioning: on the keys themselves the shuffle
    would be taken for the join's own and dropped.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.xxhash64(*keys))


def pair_units(q: DataFrame, m: DataFrame, book: Sequence[str] = BOOK) -> DataFrame:
    """Units present in both readings."""
    keys = [*book, "unit_no"]
    left = q.select(*keys, F.col("content").alias("q_raw"))
    return left.join(m.select(*keys, F.col("content").alias("m_raw")), keys, "inner")


def base_words(asks: DataFrame, base_pages: DataFrame, book: Sequence[str] = BOOK) -> DataFrame:
    """Texts of the base pages that readings name, for the units that name them.

    ``asks`` has ``unit_no``, ``page_number`` and, as ``own``, whether the first reading names the page; the result
    has ``page_number``, ``text``, ``by_q`` and ``by_m`` per unit.  Pages and asks are grouped as one table: a page's
    text is shuffled to its number once.
    """
    page = [*book, "page_number"]
    none = F.lit(None)
    named = asks.groupBy(*page, "unit_no").agg(F.bool_or("own").alias("by_q"), F.bool_or(~F.col("own")).alias("by_m"))
    ask = F.struct("unit_no", "by_q", "by_m")
    rows = named.select(*page, ask.alias("_ask"), none.cast("string").alias("text"), F.lit(False).alias("_page"))
    rows = rows.union(base_pages.select(*page, none.cast(rows.schema["_ask"].dataType), "text", F.lit(True)))
    met = rows.groupBy(*page).agg(F.collect_list("_ask").alias("_asks"), F.collect_list(F.when(F.col("_page"), F.struct("text"))).alias("_texts"))
    met = met.select(*page, "_asks", F.explode("_texts").alias("_t"))
    return met.select(*page, "_t.text", F.explode("_asks").alias("_ask")).select(*page, "text", "_ask.*")


def _readings(sides: dict[str, DataFrame], asked: DataFrame, book: Sequence[str], clean: dict) -> DataFrame:
    """One row per unit: its readings as (line of words, pages named) and the base pages that it names.

    All are put together by one shuffle of one table, words as blank-joined lines, which take a third of the room of
    lists.  The explicit partition count keeps adaptive execution from merging partitions, as in ``spread``.
    """
    keys = [*book, "unit_no"]
    reading, page = "struct<line:string,pages:array<int>>", asked.select(F.struct("page_number", "text", "by_q", "by_m").alias("p")).schema["p"].dataType
    rows = [
        df.select(*keys, F.lit(side).alias("side"), F.struct(F.array_join(T.reading_words(F.col("content"), **clean), " ").alias("line"), T.page_numbers(F.col("content")).alias("pages")).alias("r"),
                  F.lit(None).cast(page).alias("p"))
        for side, df in sides.items()
    ]
    rows.append(asked.select(*keys, F.lit("c").alias("side"), F.lit(None).cast(reading).alias("r"), F.struct("page_number", "text", "by_q", "by_m").alias("p")))
    of = lambda side: F.collect_list(F.when(F.col("side") == side, F.col("r"))).alias(f"_{side}s")
    n = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return reduce(DataFrame.union, rows).repartition(n, *keys).groupBy(*keys).agg(*(of(s) for s in sides), F.collect_list("p").alias("_ps"))


def aligned(q: DataFrame, m: DataFrame, base_pages: DataFrame, book: Sequence[str] = BOOK, o: DataFrame | None = None,
            params: Params = DEFAULT, strict: bool = True, keep_unpaged: bool = True) -> DataFrame:
    """Both readings and the base of every unit that is in both, aligned.

    Adds token arrays, the opcodes of q against m, and the index map of q into
    the base (and into a fourth reading ``o``).  A unit covers the pages that q marks in it, else those that m marks.
    Units where a reading is empty are dropped; units without page markers keep an empty base or, with
    ``keep_unpaged=False``, are dropped too.
    """
    keys = [*book, "unit_no"]
    clean = dict(titles=params.running_titles, authors=params.author_prefixes, strict=strict)
    sides = {"q": q, "m": m} | ({} if o is None else {"o": o})
    asks = [df.select(*keys, F.explode(F.array_distinct(T.page_numbers(F.col("content")))).alias("page_number"), F.lit(own).alias("own")) for df, own in ((q, True), (m, False))]
    units = _readings(sides, base_words(asks[0].union(asks[1]), base_pages, book), book, clean)
    # the base of a unit by q's pages and by m's, made before readings are taken apart
    of = lambda named: F.array_join(T.tokens_ws(F.concat_ws(" ", F.sort_array(F.transform(F.filter("_ps", lambda p: p[named]), lambda p: F.struct(p["page_number"], p["text"].alias("text")))).getField("text"))), " ")
    units = units.select(*keys, *(f"_{s}s" for s in sides), of("by_q").alias("_cq"), of("by_m").alias("_cm"))
    for s in sides:
        units = units.select(*[c for c in units.columns if c != f"_{s}s"], F.explode(f"_{s}s").alias(f"_{s}")).filter(F.col(f"_{s}.line") != "")
    # a unit without a key is in no other reading
    units = units.filter(reduce(Column.__and__, (F.col(k).isNotNull() for k in keys)))
    own = F.size("_q.pages") > 0
    units = units.withColumn("pages", F.when(own, F.col("_q.pages")).otherwise(F.col("_m.pages")))
    if not keep_unpaged:
        units = units.filter(F.size("pages") > 0)
    units = units.select(*keys, "pages", *(F.col(f"_{s}.line").alias(f"_{s}") for s in sides), F.when(own, F.col("_cq")).otherwise(F.col("_cm")).alias("_c"))
    others = ["q", "m", "c"] if o is None else ["q", "m", "c", "o"]
    units = units.withColumn("ops", A.opcodes_folded(F.col("_q"), F.col("_m"))).withColumn("_qc", A.opcodes_folded(F.col("_q"), F.col("_c")))
    if o is not None:
        units = units.withColumn("_qo", A.opcodes_folded(F.col("_q"), F.col("_o")))
    maps = [("c", "_qc")] if o is None else [("c", "_qc"), ("o", "_qo")]
    for w, ops in maps:
        units = units.withColumn(f"{w}_map", A.index_map(F.col(ops))).withColumn(f"{w}_mapped", A.mapped_count(F.col(f"{w}_map")))
    cut = lambda s: F.when(F.col(s) != "", F.split(s, " ")).otherwise(F.array().cast("array<string>"))
    return units.select(*keys, "pages", *(cut(f"_{w}").alias(w) for w in others), "ops", *(f"{w}_{x}" for w, _ in maps for x in ("map", "mapped")))


def _explode(units: DataFrame, spans: Column, book: Sequence[str]) -> DataFrame:
    """Only the finished span structs leave the row; token arrays are not copied per span."""
    return units.select(*book, "unit_no", "pages", F.explode(spans).alias("s")).select(*book, "unit_no", "pages", "s.*")


def _spans(units: DataFrame, k: int, params: Params, finish=None, contexts: bool = True) -> Column:
    """Array of one struct per disagreement of q and m; ``finish`` may rework it inside the row.

    Nothing prunes fields inside a lambda, so a caller that needs no contexts says so.
    """
    fourth = "o" in units.columns
    needed = ["ops", "q", "m", "c", "c_map", "c_mapped", *(["o", "o_map", "o_mapped"] if fourth else []), *(["c_sig"] if "c_sig" in units.columns else [])]

    def span(u: Column, op: Column, no: Column) -> Column:
        i1, i2, j1, j2 = op["i1"], op["i2"], op["j1"], op["j2"]
        fields = [
            no.alias("span_no"), i1.alias("i1"), i2.alias("i2"), j1.alias("j1"), j2.alias("j2"),
            A.take_words(u["q"], i1, i2).alias("q_span"),
            A.take_words(u["m"], j1, j2).alias("m_span"),
            A.anchor_span(u["c_map"], u["c_mapped"], u["c"], i1, i2, params).alias("c_span"),
        ]
        if contexts:
            fields += [
                T.left_context(u["q"], i1, k).alias("left_ctx"),
                T.right_context(u["q"], i2, k).alias("right_ctx"),
                T.left_context(u["m"], j1, k).alias("m_left"),
                T.right_context(u["m"], j2, k).alias("m_right"),
            ]
        if fourth:
            fields.append(A.anchor_span(u["o_map"], u["o_mapped"], u["o"], i1, i2, params).alias("o_span"))
        return F.struct(*fields)

    def all_spans(u: Column) -> Column:
        made = F.transform(A.changes(u["ops"]), lambda op, no: span(u, op, no))
        return made if finish is None else finish(u, made)

    return T.let(F.struct(*[F.col(c) for c in needed]), all_spans)


def divergences(units: DataFrame, book: Sequence[str] = BOOK, context: int | None = None, params: Params = DEFAULT, contexts: bool = True) -> DataFrame:
    """One row per disagreement of q and m, with the base's reading and the majority class."""
    rows = _explode(units, _spans(units, params.context if context is None else context, params, contexts=contexts), book)
    return rows.withColumn("type", P.majority_class(F.col("q_span"), F.col("m_span"), F.col("c_span")))


def unresolved(spans: DataFrame) -> DataFrame:
    """Spans where all three readings differ."""
    return spans.filter(F.col("type") == "Q≠M≠C")


def affected_units(spans: DataFrame, book: Sequence[str] = BOOK) -> DataFrame:
    """Units with at least one unresolved span."""
    return unresolved(spans).select(*book, "unit_no").distinct()


def by_unit(spans: DataFrame, book: Sequence[str] = BOOK) -> DataFrame:
    """The unresolved spans of a unit as one adjudication request."""
    item = F.struct("span_no", "q_span", "m_span", "c_span", "left_ctx", "right_ctx")
    return unresolved(spans).groupBy(*book, "unit_no").agg(F.sort_array(F.collect_list(item)).alias("spans"), F.count("*").alias("n_spans"))


def drift(q_span: Column, m_span: Column, q_ctx: Column, m_ctx: Column, min_len: int = DEFAULT.drift_min_len) -> Column:
    """Words of one reading that the other has elsewhere nearby: struct(likely, words, label)."""
    def out(side: str, words: Column, head: str, tail: str) -> Column:
        return F.struct(
            F.lit(side).alias("likely"), words.alias("words"),
            F.concat(F.lit(head), F.array_join(words, ", "), F.lit(tail)).alias("label"),
        )

    def told(x: Column) -> Column:
        q_in_m, m_in_q = x["q_in_m"], x["m_in_q"]
        has_q, has_m = F.size(q_in_m) > 0, F.size(m_in_q) > 0
        return (
            F.when(has_q & ~has_m, out("Q", q_in_m, "near by in M: ", ""))
            .when(has_m & ~has_q, out("M", m_in_q, "near by in Q: ", ""))
            .when(has_q & has_m, out("ambiguous", F.array_sort(F.array_union(q_in_m, m_in_q)), "near by in either: ", ""))
        )

    def sought(s: Column) -> Column:
        found = F.struct(
            F.array_sort(F.array_intersect(s["q"], T.sig_words(m_ctx, min_len))).alias("q_in_m"),
            F.array_sort(F.array_intersect(s["m"], T.sig_words(q_ctx, min_len))).alias("m_in_q"),
        )
        return F.when((F.size(s["q"]) > 0) & (F.size(s["m"]) > 0), T.let(found, told))

    return T.let(F.struct(T.sig_words(q_span, min_len).alias("q"), T.sig_words(m_span, min_len).alias("m")), sought)


def enriched(units: DataFrame, book: Sequence[str] = BOOK, params: Params = DEFAULT) -> DataFrame:
    """Unresolved spans with category, drift, a wide base excerpt and a suggestion.

    The base tokens are folded once per unit, and the excerpt is cut inside the
    unit's row, so only finished spans leave it.
    """
    units = units.withColumn("c_sig", T.bare_words(F.col("c")))

    def widen(u: Column, made: Column) -> Column:
        still_open = F.filter(made, lambda s: P.majority_class(s["q_span"], s["m_span"], s["c_span"]) == "Q≠M≠C")
        target = lambda s: F.when(s["q_span"] != "", s["q_span"]).otherwise(s["m_span"])
        return F.transform(still_open, lambda s: F.struct(s.alias("s"), T.wide_context(u["c"], target(s), params.page_context, u["c_sig"]).alias("wide")))

    rows = units.select(*book, "unit_no", "pages", F.explode(_spans(units, params.report_context, params, widen)).alias("x"))
    rows = rows.select(*book, "unit_no", "pages", "x.s.*", F.col("x.wide.before").alias("page_ctx_before"), F.col("x.wide.after").alias("page_ctx_after"))
    q_ctx, m_ctx = F.concat_ws(" ", "left_ctx", "right_ctx"), F.concat_ws(" ", "m_left", "m_right")
    return (
        rows.withColumn("category", P.difference_category(F.col("q_span"), F.col("m_span")))
        .withColumn("_d", drift(F.col("q_span"), F.col("m_span"), q_ctx, m_ctx, params.drift_min_len))
        .withColumn("drift_label", F.col("_d.label"))
        .withColumn("likely_correct", F.col("_d.likely"))
        .withColumn("drift_words", F.col("_d.words"))
        .withColumn("suggestion", suggestion(F.col("likely_correct"), F.col("q_span"), F.col("m_span")))
        .withColumn("page_label", T.page_label(F.col("pages")))
        .drop("_d")
    )


def suggestion(likely: Column, q: Column, m: Column) -> Column:
    """U4: the reading the drift points to."""
    return F.when(likely == "Q", q).when(likely == "M", m).otherwise("")


def high_severity(spans: DataFrame) -> DataFrame:
    """Unresolved spans of the three most severe categories."""
    marked = unresolved(spans).withColumn("category", P.difference_category(F.col("q_span"), F.col("m_span"), "mark"))
    return marked.filter(P.is_high_severity(F.col("category"))).withColumn("pages", F.array_sort(F.array_distinct("pages")))


def page_flags(spans: DataFrame, book: Sequence[str] = BOOK) -> DataFrame:
    """Severe spans per page.

    A page's spans come from the units that cover it, so the list is bounded by
    the page itself.
    """
    item = F.struct(
        F.col("unit_no"), F.col("span_no"), F.col("q_span").alias("q"), F.col("m_span").alias("m"),
        F.coalesce("c_span", F.lit("—")).alias("base"), F.col("category").alias("cat"),
    )
    per_page = spans.select(*book, F.explode("pages").alias("page_number"), item.alias("item"))
    listed = per_page.groupBy(*book, "page_number").agg(F.sort_array(F.collect_list("item")).alias("_items"))
    plain = F.transform("_items", lambda i: F.struct(i["q"].alias("q"), i["m"].alias("m"), i["base"].alias("base"), i["cat"].alias("cat")))
    return listed.select(*book, "page_number", F.lit(True).alias("_uncertain"), plain.alias("_uncertain_spans"))


def mark_pages(pages: DataFrame, flags: DataFrame, book: Sequence[str] = BOOK) -> DataFrame:
    """Structured pages with their uncertainty flags."""
    return pages.drop("_uncertain", "_uncertain_spans").join(flags, [*book, "page_number"], "left")


def appendix(pages: DataFrame, book: Sequence[str] = BOOK) -> DataFrame:
    """One row per uncertain reading."""
    return pages.filter(F.col("_uncertain")).select(*book, "page_number", F.explode("_uncertain_spans").alias("s")).select(
        *book, "page_number", "s.*"
    )


def severity_rank(category: Column) -> Column:
    """Position of a category in the severity order."""
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), category), F.lit(0)) - 1, F.lit(99))


def report_order(spans: DataFrame) -> list[Column]:
    """O3: severe spans first, those with drift before the rest, then by severity and place."""
    high = P.is_high_severity(F.col("category"))
    side = F.when(F.col("likely_correct") == "Q", 0).when(F.col("likely_correct") == "M", 1).when(F.col("likely_correct") == "ambiguous", 2).otherwise(3)
    return [
        F.when(high, 0).otherwise(1),
        F.when(high & F.col("drift_label").isNotNull(), 0).when(high, 1).otherwise(2),
        F.when(high, side).otherwise(4),
        F.when(high, 0).otherwise(severity_rank(F.col("category"))),
    ]


def counts_with_share(rows: DataFrame, key: str, group: Sequence[str] = ()) -> DataFrame:
    """Count per value and its percentage of the total.

    The total is summed from the counts, so the window sees one row per value.
    """
    from pyspark.sql import Window

    counts = rows.groupBy(*group, key).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*group)) if group else F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("pct", 100.0 * F.col("n") / total)
