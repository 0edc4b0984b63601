"""The store of reviewed spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variorum.functions import text as T

EXPORT = ("id", "pdf", "spread", "pages", "chapter", "q_span", "m_span", "c_span", "category", "drift", "likely",
          "correction", "status", "saved")


def upsert(store: DataFrame, saved: DataFrame, key: Sequence[str] = ("key",), at: str = "timestamp") -> DataFrame:
    """The latest save of a key wins; a save beats the store on equal times."""
    both = store.withColumn("_new", F.lit(0)).unionByName(saved.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in key and c != "_new"]
    return both.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(at, "_new", *[c for c in rest if c != at])).alias("v")).select(*key, "v.*")


def overlay(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key."""
    return old.join(new.select(*key), list(key), "left_anti").unionByName(new, allowMissingColumns=True)


def meta(span: Sequence[str]) -> Column:
    """The span's identity as JSON beside its correction."""
    return F.to_json(F.struct(*span))


def reviewed(store: DataFrame) -> DataFrame:
    """Rows someone has decided on."""
    return store.filter(F.col("status").isNotNull() & (F.col("status") != "unreviewed"))


def export_json(store: DataFrame, path: str) -> None:
    """S20."""
    reviewed(store).write.mode("errorifexists").json(path)


def export_csv(store: DataFrame, path: str) -> None:
    """Every field quoted."""
    flat = reviewed(store).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in store.columns])
    flat.write.mode("errorifexists").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def progress(store: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """G21."""
    done = F.col("status").isNotNull() & (F.col("status") != "unreviewed")
    return store.groupBy(*group).agg(F.count("*").alias("total"), F.count_if(done).alias("reviewed"), F.count_if(F.col("status") == "corrected").alias("corrected"))


def cleared(store: DataFrame) -> DataFrame:
    """The empty store."""
    return store.filter(F.lit(False))


def numbered(spans: DataFrame, book: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Ordinal and id of every span of a book in report order."""
    from pyspark.sql import Window

    rows = spans.withColumn("ordinal", F.row_number().over(Window.partitionBy(*book).orderBy(*order)))
    return rows.withColumn("span_id", T.span_id(F.col(book[0]), F.col("unit_no"), F.col("ordinal")))


def section_headers(spans: DataFrame, book: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whether a span opens a new category in report order."""
    from pyspark.sql import Window

    w = Window.partitionBy(*book).orderBy(*order)
    return spans.withColumn("opens_section", F.coalesce(F.lag("category").over(w) != F.col("category"), F.lit(True)))
