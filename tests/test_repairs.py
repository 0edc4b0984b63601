"""Rows that once crashed or were lost."""

import time
import unicodedata

from pyspark.sql import functions as F

from variorum.functions import text as T
from variorum.operators import fallback, score
from variorum.params import Params
from variorum.sources import unit_log
from variorum.streaming import resume


def test_strong_fold_covers_all_characters(spark):
    words = ["𝐀𝐛", "㎯", "ﬁn", "Å", "é'x", "…", "⑴", "plain", "﷼"]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", T.fold_strong(F.col("w")).alias("f")).collect()
    for r in rows:
        want = unicodedata.normalize("NFKD", r.w.lower()).encode("ascii", "ignore").decode().replace("'", "")
        assert r.f.lower() == want.lower().strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"), r.w


def test_long_page_numbers_do_not_stop_a_job(spark):
    df = spark.createDataFrame([("[Page 99999999999] x [Page 7]",)], "t string")
    assert df.select(T.page_numbers(F.col("t")).alias("n")).first().n == [None, 7]


def test_recover_with_blocks_that_fold_to_nothing(spark):
    blocks = spark.createDataFrame([(1, 1, 0, "— —"), (1, 1, 1, ""), (1, 1, 2, None)], "book int, page_number int, block_idx int, text string")
    units = spark.createDataFrame([(1, 1, "some words stand here\n\nand others there")], "book int, page_number int, content string")
    paras = units.select("book", "page_number", fallback.reread_paragraphs(F.col("content")).alias("paras"))
    rows = fallback.recover(blocks, paras, ["book"]).collect()
    assert len(rows) == 3 and all(r.recall == 0.0 and r.status in ("too_short", "unresolved") for r in rows)


def test_buckets_without_pages_stay(spark):
    pages = spark.createDataFrame([(1, 1, "one two"), (1, 9, "three")], "book int, page_number int, text string")
    rows = score.bucket_bounds(pages, ["book"], Params(bucket_pages=2)).orderBy("bucket").collect()
    assert [(r.bucket, r.page_from, r.page_to, r.c_words) for r in rows] == [(0, 1, 2, 2), (1, 3, 4, 0), (2, 5, 6, 0), (3, 7, 8, 0), (4, 9, 9, 1)]


def test_stream_keeps_the_last_of_a_repeated_key(spark, tmp_path):
    src, ck, out = (str(tmp_path / n) for n in ("in", "ck", "out"))
    unit = lambda text: spark.createDataFrame([("a", 1, 1, text)], "book string, unit_no int, total int, content string").coalesce(1)
    unit_log.append_units(unit("first"), src)
    time.sleep(0.05)
    unit_log.append_units(unit("second"), src)
    resume.follow(spark, src, ck, out).awaitTermination()
    assert [r.content for r in spark.read.parquet(out).collect()] == ["second"]
