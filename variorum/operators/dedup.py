"""Removal of text that a page repeats from the pages before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variorum.functions import align as A
from variorum.functions import text as T
from variorum.operators import ordered, pagewise
from variorum.operators.spans import BOOK
from variorum.params import DEFAULT, Params
from variorum.scratch import checkpoint_folder


def _materialise(df: DataFrame) -> DataFrame:
    """Cut the plan between rounds with a reliable checkpoint."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def trim_words(blocks: Column, offset: Column, n: Column) -> Column:
    """K1: blocks without n paragraph words from ``offset`` on; emptied paragraphs go."""
    end = offset + n
    sized = F.transform(blocks, lambda b: F.struct(b.alias("b"), F.when(b["type"] == "paragraph", T.tokens_ws(b["text"])).alias("w")))

    def cut(all_: Column, s: Column, i: Column) -> Column:
        before = F.filter(F.slice(all_, F.lit(1), i), lambda x: x["w"].isNotNull())
        start = F.aggregate(before, F.lit(0), lambda acc, x: acc + F.size(x["w"]))
        size = F.size(s["w"])
        left = F.greatest(F.lit(0), F.least(size, offset - start))
        right = F.greatest(F.lit(0), F.least(size, end - start))
        kept = F.concat(F.slice(s["w"], F.lit(1), left), F.slice(s["w"], right + 1, size))
        hit = (start + size > offset) & (start < end)
        text = F.when(hit, F.array_join(kept, " ")).otherwise(s["b"]["text"])
        changed = F.struct(s["b"]["type"].alias("type"), text.alias("text"))
        gone = hit & (F.size(kept) == 0)
        plain = F.struct(s["b"]["type"].alias("type"), s["b"]["text"].alias("text"))
        return F.when(s["w"].isNull(), plain).when(~gone, changed)

    return T.let(sized, lambda all_: F.filter(F.transform(all_, lambda s, i: cut(all_, s, i)), lambda b: b.isNotNull()))


def token_set(text: Column) -> Column:
    """Distinct Latin tokens of a block."""
    return F.array_distinct(T.tokens_latin(F.coalesce(text, F.lit(""))))


def is_repeat(text: Column, prior: Column, params: Params = DEFAULT) -> Column:
    """K2: the block is long enough and close to any earlier block's token set."""
    long_enough = F.size(T.tokens_latin(text)) >= params.block_min_words
    close = T.let(token_set(text), lambda mine: F.exists(prior, lambda p: T.overlap_similarity(p, mine) >= params.block_min_sim))
    return long_enough & close


def lookback_pairs(blocks: DataFrame, book: Sequence[str] = BOOK, params: Params = DEFAULT) -> DataFrame:
    """Similar blocks up to ``lookback`` pages back, each pair scored.

    Later blocks ask for each earlier page by key, so this is an equi-join on
    (book, page rank); pairs stay within a handful of pages.
    """
    rows = blocks.filter(F.col("type") == "paragraph").withColumn("_s", token_set(F.col("text")))
    late = rows.filter(F.size(T.tokens_latin("text")) >= params.block_min_words)
    steps = F.array(*[F.lit(d) for d in range(1, params.lookback + 1)])
    asked = late.select(*book, F.col("page_rank").alias("b_rank"), F.col("block_idx").alias("b_idx"), F.col("_s").alias("_b"), F.explode(steps).alias("_d"))
    asked = asked.withColumn("a_rank", F.col("b_rank") - F.col("_d")).drop("_d")
    early = rows.select(*book, F.col("page_rank").alias("a_rank"), F.col("block_idx").alias("a_idx"), F.col("_s").alias("_a"))
    scored = asked.join(early, [*book, "a_rank"], "inner").withColumn("similarity", T.overlap_similarity(F.col("_a"), F.col("_b")))
    return scored.filter(F.col("similarity") >= params.block_min_sim).drop("_a", "_b")


def boundary_overlap(tail: Column, head: Column, params: Params = DEFAULT) -> Column:
    """Where the head of a page repeats the tail of the one before: struct(head_start, match_len)."""
    t = F.slice(tail, F.greatest(F.lit(1), F.size(tail) - params.overlap_sample + 1), F.lit(params.overlap_sample))
    h = F.slice(head, F.lit(1), F.lit(params.overlap_sample))
    usable = (F.size(tail) > 0) & (F.size(head) > 0)
    blocks = A.matching_blocks(F.when(usable, F.array_join(t, " ")), F.when(usable, F.array_join(h, " ")))
    return A.best_boundary_overlap(F.coalesce(blocks, F.array().cast(f"array<{A.BLOCK}>")), F.size(t), params)


def _alone(pages: DataFrame, book: Sequence[str], params: Params, width: int) -> DataFrame:
    """Every page as its predecessors' original texts would leave it: new (null if unchanged), action, n_trimmed, changed.

    Pages are dealt in stretches of ``width``; the last pages of a stretch also go to the next one.
    """
    back = params.lookback + 1
    rows = _with_context(pages.withColumn("_part", F.floor(F.col("_idx") / F.lit(float(width)))), "_part", F.col("_idx") % width >= width - back)
    # dealt once, as bare pages: token sets and tails are made and used where the pages are; the count is explicit as in `spread`
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *book, "_part")
    w = Window.partitionBy(*book, "_part").orderBy("_idx")
    para_sets = F.transform(F.filter("orig", lambda b: b["type"] == "paragraph"), lambda b: token_set(b["text"]))
    rows = rows.withColumn("_sets", para_sets).withColumn("_prev", F.lag("orig").over(w)).withColumn("_has", F.lag(F.lit(True)).over(w))
    # the page right before is not looked at, except when it is the first page
    sets = [F.coalesce(F.lag("_sets", d).over(w), F.when(F.col("_has"), F.first("_sets").over(w))) for d in range(2, back + 1)]
    for i, c in enumerate(sets):
        rows = rows.withColumn(f"_p{i}", c)
    rows = rows.filter("_own")
    empty = F.array().cast("array<array<string>>")
    prior = F.concat(*[F.coalesce(f"_p{i}", empty) for i in range(len(sets))])
    rows = rows.withColumn("_tail", T.tokens_latin(T.blocks_text(F.coalesce("_prev", F.slice("orig", 1, 0)))))
    rows = rows.withColumn("_head", T.tokens_latin(T.blocks_text(F.col("orig")))).withColumn("_prior", prior)
    rows = rows.withColumn("_o", boundary_overlap(F.col("_tail"), F.col("_head"), params))
    live = (F.size("_tail") > 0) & (F.size("_head") > 0) & F.coalesce("_has", F.lit(False))
    base = F.least(F.size("_tail"), F.size("_head"), F.lit(params.overlap_ratio_window))
    trims = live & (F.col("_o.match_len") >= params.overlap_min_words) & (F.col("_o.match_len") / base >= params.overlap_min_ratio)
    pruned = F.filter("orig", lambda b: ~((b["type"] == "paragraph") & F.coalesce(is_repeat(b["text"], F.col("_prior"), params), F.lit(False))))
    new = F.when(trims, trim_words(F.col("orig"), F.col("_o.head_start"), F.col("_o.match_len"))).when(live, pruned).otherwise(F.col("orig"))
    action = F.when(trims, "overlap").when(live & (F.size(pruned) < F.size("orig")), "repeat").otherwise("kept")
    out = rows.select(*book, "page_rank", "_idx", "orig", new.alias("new"), action.alias("action"), F.when(trims, F.col("_o.match_len")).otherwise(0).alias("n_trimmed"))
    out = out.withColumn("changed", ~F.col("new").eqNullSafe(F.col("orig")))
    return out.withColumn("new", F.when(F.col("changed"), F.col("new")))


def _with_context(rows: DataFrame, part: str, also_next: Column) -> DataFrame:
    """Rows in their part, and those that the next part has to see there too, not as its own."""
    own = F.struct(F.col(part).alias("p"), F.lit(True).alias("own"))
    both = F.array(own, F.struct((F.col(part) + 1).alias("p"), F.lit(False).alias("own")))
    out = rows.withColumn("_x", F.explode(F.when(also_next, both).otherwise(F.array(own))))
    return out.withColumn(part, F.col("_x.p")).withColumn("_own", F.col("_x.own")).drop("_x")


def deduplicate(pages: DataFrame, book: Sequence[str] = BOOK, params: Params = DEFAULT, width: int = 256, calm: int = 8) -> DataFrame:
    """K1-K3: pages from left to right, each compared with its already trimmed predecessors.

    First every page is worked out against its predecessors' original texts, all at once.  That is
    its result unless one of them changed.  So books are cut into segments at pages before which
    ``calm`` pages were left as they were, and a segment is passed through in order with the last
    pages' results as state; only pages after a changed one are worked out again.  A segment
    starts from unchanged pages; where the one before ends with changed ones after all, the whole
    book is passed through in one go.  ``pages`` has page_rank (an integer, unique in its book)
    and content_blocks.
    """
    book = list(book)
    back = params.lookback + 1
    if calm < back or width <= back:
        raise ValueError(f"segments need {back} pages of context")
    plain = F.transform("content_blocks", lambda b: F.struct(b["type"].alias("type"), b["text"].alias("text")))
    rows = ordered.with_bucket(pages.select(*book, "page_rank", plain.alias("orig")), "page_rank", name="_b")
    rows = ordered.row_number(rows, book, ["page_rank"], "_idx", "_b").drop("_b").withColumn("_idx", F.col("_idx").cast("long") - 1)
    alone = _materialise(_alone(rows, book, params, width))
    # a segment may start at every 16th page that has been calm for long enough
    marks = ordered.with_bucket(alone.select(*book, "_idx", "changed"), "_idx", name="_b")
    marks = ordered.running_max(marks, book, ["_idx"], F.when(F.col("changed"), F.col("_idx")), "_last", "_b")
    fresh = (F.col("_idx") == 0) | ((F.col("_idx") % 16 == 0) & (F.col("_idx") - F.coalesce("_last", F.lit(-calm - 1)) > calm))
    marks = ordered.islands(marks, book, ["_idx"], fresh, "_seg", "_b").select(*book, "_idx", "_seg")
    joined = alone.join(marks, [*book, "_idx"])
    starts = marks.groupBy(*book, "_seg").agg(F.min("_idx").alias("_start"))
    ahead = starts.select(*book, (F.col("_seg") - 1).alias("_seg"), F.col("_start").alias("_end"))
    joined = joined.join(ahead, [*book, "_seg"], "left").withColumn("_end", F.coalesce("_end", F.lit(1 << 62)))
    tail = F.col("_idx") >= F.col("_end") - back
    dealt = _with_context(joined.withColumn("_tail", tail), "_seg", tail)
    done = _materialise(_passed(dealt, book, params))
    uncalm = _materialise(done.filter("_tail and changed").select(*book).distinct())
    kept = F.when(F.col("changed"), F.col("new")).otherwise(F.col("orig"))
    if uncalm.isEmpty():  # as good as always; else all pages are shuffled for nothing
        return done.select(*book, "page_rank", kept.alias("content_blocks"), "action", "n_trimmed")
    again = _passed(alone.join(uncalm, book, "left_semi").withColumn("_seg", F.lit(0).cast("long")).withColumn("_own", F.lit(True)).withColumn("_tail", F.lit(False)), book, params)
    out = done.join(uncalm, book, "left_anti").unionByName(again)
    return out.select(*book, "page_rank", kept.alias("content_blocks"), "action", "n_trimmed")


def _passed(rows: DataFrame, book: Sequence[str], params: Params) -> DataFrame:
    """The pages of each segment, passed through in order."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    names = [*book, "_seg", "_idx", "page_rank", "orig", "new", "action", "n_trimmed", "changed", "_tail"]
    schema = ", ".join(f"`{c}` {types[c]}" for c in names)
    dealt = rows.select(*names, "_own").repartition(F.xxhash64(*book, "_seg")).sortWithinPartitions(*book, "_seg", "_idx")
    n = len(book) + 1
    return dealt.mapInArrow(lambda b: pagewise.passed(b, n, params), schema)


def duplicate_blocks(pairs: DataFrame, blocks: DataFrame, book: Sequence[str] = BOOK) -> DataFrame:
    """Blocks without those that repeat an earlier one."""
    gone = pairs.select(*book, F.col("b_rank").alias("page_rank"), F.col("b_idx").alias("block_idx")).distinct()
    return blocks.join(gone, [*book, "page_rank", "block_idx"], "left_anti")


def ngrams(tokens: Column, n: int, last: bool = True) -> Column:
    """Blank-joined n-grams; ``last=False`` leaves out the final window."""

    def windows(ts: Column) -> Column:
        count = F.size(ts) - n + (1 if last else 0)
        starts = F.when(count > 0, F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(ts, i + k) for k in range(n)]))

    return T.let(tokens, windows)


def repeating_ngrams(tokens: Column, n: int, repeats: int, last: bool = True) -> Column:
    """The n-grams of a text, or none if fewer than ``repeats`` of them recur: most texts end here, inside their row."""
    none = F.array().cast("array<string>")
    return T.let(ngrams(tokens, n, last), lambda g: F.when(F.size(g) - F.size(F.array_distinct(g)) >= repeats, g).otherwise(none))


def repetition_loop(texts: DataFrame, text: str, keys: Sequence[str], params: Params = DEFAULT) -> DataFrame:
    """Texts whose most frequent n-gram recurs, with that n-gram (earliest wins ties).

    A text without enough repeats is dismissed inside its row by comparing the
    number of n-grams with the number of distinct ones; only the others are
    exploded and counted.
    """
    held = repeating_ngrams(T.tokens_ws(F.col(text)), params.loop_ngram, params.loop_count - 1)
    grams = texts.select(*keys, F.posexplode(held).alias("pos", "phrase"))
    counts = grams.groupBy(*keys, "phrase").agg(F.count("*").alias("n"), F.min("pos").alias("pos"))
    top = counts.filter(F.col("n") >= params.loop_count).groupBy(*keys).agg(F.max_by(F.struct("phrase", "n"), F.struct("n", -F.col("pos"))).alias("v"))
    return top.select(*keys, "v.phrase", "v.n")


def repeated_phrase(pages: DataFrame, text: str, keys: Sequence[str], params: Params = DEFAULT, compat: bool = True) -> DataFrame:
    """First n-gram of a page seen again more than ``repeat_distance`` words after its last sighting.

    ``compat`` leaves out the final window of a page, as the original check does.
    """
    held = repeating_ngrams(T.tokens_ws(F.col(text)), params.repeat_ngram, 1, last=not compat)
    grams = pages.select(*keys, F.posexplode(held).alias("pos", "phrase"))
    w = Window.partitionBy(*keys, "phrase").orderBy("pos")
    hits = grams.withColumn("_d", F.col("pos") - F.lag("pos").over(w)).filter(F.col("_d") > params.repeat_distance)
    return hits.groupBy(*keys).agg(F.min_by("phrase", "pos").alias("phrase"), F.min("pos").alias("pos"))
