"""Incremental intake of unit logs: resume, skip what is done, append the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from variorum.sources.unit_log import HEAD_RE, START, _parsed, complete_units


def high_water(blocks: DataFrame, book: Sequence[str] = ("book",)) -> DataFrame:
    """V1: number of the last closed block before the first unclosed one, per book.

    ``place`` orders blocks within a book's log.
    """
    closed = F.col("content").isNotNull()
    broken = blocks.groupBy(*book).agg(F.min(F.when(~closed, F.col("place"))).alias("_stop"))
    ok = blocks.join(broken, list(book), "left").filter(closed & (F.col("_stop").isNull() | (F.col("place") < F.col("_stop"))))
    return ok.groupBy(*book).agg(F.max_by("unit_no", "place").alias("last_done"))


def pending(wanted: DataFrame, done: DataFrame, keys: Sequence[str] = ("book", "unit_no")) -> DataFrame:
    """V2: wanted units that have no finished block.

    Unlike a high-water mark this never skips a gap in a sparse list of units.
    """
    return wanted.join(done.select(*keys), list(keys), "left_anti")


def targeted(wanted: DataFrame, done: DataFrame, produced: DataFrame, keys: Sequence[str] = ("book", "unit_no")) -> DataFrame:
    """V5: finished units re-read, the others taken from what was just produced."""
    return done.join(wanted.select(*keys), list(keys), "left_semi").unionByName(
        produced.join(pending(wanted, done, keys).select(*keys), list(keys), "left_semi")
    )


def follow(spark: SparkSession, folder: str, checkpoint: str, out: str, once: bool = True) -> StreamingQuery:
    """V1/V2 as a stream: new log files in a folder become unit rows exactly once.

    The checkpoint remembers which files were read; within a micro-batch, and
    against what was already written, a repeated key is kept only once: the last
    of a batch, as in `complete_units`, unless an earlier batch had it.
    """
    raw = spark.readStream.option("lineSep", START).text(folder)
    meta = [F.col(f"_metadata.{c}").alias(c) for c in ("file_modification_time", "file_path", "file_block_start")]
    units = raw.select("value", *meta).filter(F.col("value").rlike(HEAD_RE))

    def sink(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        place = F.struct("file_modification_time", "file_path", "file_block_start", F.monotonically_increasing_id().alias("n"))
        fresh = complete_units(batch.select(*_parsed(F.col("value")), place.alias("place"))).select("book", "unit_no", "total", "content")
        try:
            # a batch replayed after a failure overwrites its own folder, so it is not its own past
            done = session.read.parquet(out).filter(F.col("batch") != batch_id)
            fresh = fresh.join(done.select("book", "unit_no"), ["book", "unit_no"], "left_anti")
        except Exception as e:  # the first batch finds nothing to read
            if "PATH_NOT_FOUND" not in str(e):
                raise
        fresh.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = units.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
