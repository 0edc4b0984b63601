"""Order-dependent operators that survive one group holding most of the rows.

A window over a whole book or source puts that group into one task.  Here the
order key is cut into buckets of bounded width; windows run per (group, bucket),
and only one summary row per bucket is ordered over the whole group.  The carry
is joined back on (group, bucket), which is how the rows are already partitioned.
With ``bucket=None`` the group is known to be small (one document row exploded)
and a plain window is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variorum.scratch import checkpoint_folder

BUCKET_WIDTH = 4096


def with_bucket(df: DataFrame, order_key: str, width: int = BUCKET_WIDTH, name: str = "bucket") -> DataFrame:
    """Bucket an integer order key; unique keys bound a bucket by ``width`` rows."""
    return df.withColumn(name, F.floor(F.col(order_key) / width))


def _local(group: Sequence[str], bucket: str | None, order: Sequence[str]):
    keys = list(group) + ([bucket] if bucket else [])
    return Window.partitionBy(*keys).orderBy(*order)


def _carry(df: DataFrame, group: Sequence[str], bucket: str, agg: Column, over) -> DataFrame:
    per_bucket = df.groupBy(*group, bucket).agg(agg.alias("_v"))
    ordered = Window.partitionBy(*group).orderBy(bucket)
    return per_bucket.select(*group, bucket, over(F.col("_v"), ordered).alias("_carry"))


def _join_carry(df: DataFrame, carry: DataFrame, group: Sequence[str], bucket: str) -> DataFrame:
    return df.join(carry, [*group, bucket], "left")


def running_sum(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, out: str,
                bucket: str | None = None, inclusive: bool = False) -> DataFrame:
    """Sum of ``value`` over earlier rows of the group."""
    end = 0 if inclusive else -1
    rows = _local(group, bucket, order).rowsBetween(Window.unboundedPreceding, end)
    local = F.coalesce(F.sum(value).over(rows), F.lit(0))
    if not bucket:
        return df.withColumn(out, local)
    carry = _carry(df, group, bucket, F.sum(value),
                   lambda v, w: F.coalesce(F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return _join_carry(df.withColumn(out, local), carry, group, bucket).withColumn(out, F.col(out) + F.col("_carry")).drop("_carry")


def row_number(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str, bucket: str | None = None) -> DataFrame:
    """1-based rank of a row in its group."""
    if not bucket:
        return df.withColumn(out, F.row_number().over(_local(group, None, order)))
    return running_sum(df, group, order, F.lit(1), out, bucket, inclusive=True)


def fill_forward(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, out: str,
                 bucket: str | None = None, inclusive: bool = True) -> DataFrame:
    """Latest non-null value at or before the row."""
    rows = _local(group, bucket, order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = F.last(value, ignorenulls=True).over(rows)
    if not bucket:
        return df.withColumn(out, local)
    key = F.struct(*[F.col(c) for c in order])
    carry = _carry(df, group, bucket, F.max_by(value, F.when(value.isNotNull(), key)),
                   lambda v, w: F.last(v, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return _join_carry(df.withColumn(out, local), carry, group, bucket).withColumn(out, F.coalesce(out, "_carry")).drop("_carry")


def running_max(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, out: str,
                bucket: str | None = None, inclusive: bool = False) -> DataFrame:
    """Greatest value over earlier rows, null before the first."""
    end = 0 if inclusive else -1
    local = F.max(value).over(_local(group, bucket, order).rowsBetween(Window.unboundedPreceding, end))
    if not bucket:
        return df.withColumn(out, local)
    carry = _carry(df, group, bucket, F.max(value),
                   lambda v, w: F.max(v).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return _join_carry(df.withColumn(out, local), carry, group, bucket).withColumn(out, F.greatest(out, "_carry")).drop("_carry")


def neighbour(df: DataFrame, group: Sequence[str], order: Sequence[str], cols: Sequence[str], out: str,
              bucket: str | None = None, forward: bool = True) -> DataFrame:
    """Struct of ``cols`` from the next (or previous) row of the group, null at the end."""
    me = F.struct(*[F.col(c) for c in cols])
    shift = F.lead if forward else F.lag
    local = shift(me).over(_local(group, bucket, order))
    if not bucket:
        return df.withColumn(out, local)
    key = F.struct(*[F.col(c) for c in order])
    edge = F.min_by(me, key) if forward else F.max_by(me, key)
    carry = _carry(df, group, bucket, edge, lambda v, w: shift(v).over(w))
    return _join_carry(df.withColumn(out, local), carry, group, bucket).withColumn(out, F.coalesce(out, "_carry")).drop("_carry")


def alternate_chain(df: DataFrame, group: Sequence[str], order: Sequence[str], fires: Column, chained: Column, out: str,
                    bucket: str | None = None) -> DataFrame:
    """Solve m[i] = fires[i] and not (chained[i] and m[i-1]) without a sequential fold.

    Rows that are not both firing and chained have a known value and restart the
    chain; after a restart the value alternates, so the parity of the distance to
    the last restart decides.
    """
    fires, chained = F.coalesce(fires, F.lit(False)), F.coalesce(chained, F.lit(False))
    df = df.withColumn("_f", fires).withColumn("_open", fires & chained)
    df = row_number(df, group, order, "_rn", bucket)
    start = F.when(~F.col("_open"), F.struct(F.col("_rn").alias("rn"), F.col("_f").alias("f")))
    df = fill_forward(df, group, order, start, "_start", bucket)
    steps = F.col("_rn") - F.coalesce(F.col("_start.rn"), F.lit(0))
    first = F.coalesce(F.col("_start.f"), F.lit(False))
    even = steps % 2 == 0
    return df.withColumn(out, F.when(even, first).otherwise(~first)).drop("_f", "_open", "_rn", "_start")


def islands(df: DataFrame, group: Sequence[str], order: Sequence[str], starts: Column, out: str,
            bucket: str | None = None) -> DataFrame:
    """Number of the island a row belongs to; ``starts`` marks first rows."""
    return running_sum(df, group, order, F.when(starts, 1).otherwise(0), out, bucket, inclusive=True)


def global_rank(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Gapless 1-based rank of every row of the whole table in an order.

    Rows are dealt by ranges of the order and sorted within; a partition's rows are numbered by
    their place, and one count per partition gives where its numbers begin.  Equal rows get
    different numbers in no particular order.  The sorted rows are written once, so that a lost
    executor cannot deal them anew between the count and the numbering.
    """
    checkpoint_folder(df.sparkSession)
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    rows = dealt.checkpoint()
    # the id is the partition in its upper bits and the row's place in the lower 33
    part = F.shiftright("_row", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))  # one row per partition
    placed = rows.withColumn("_part", part).join(counts, "_part")
    return placed.withColumn(out, F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1).cast("long")) + 1).drop("_row", "_part", "_before")
