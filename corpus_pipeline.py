"""A training-corpus pipeline: each stage is one operator, and works on what the one before kept.

Each stage takes the session, the documents that its predecessor kept and the folder of the
tables, and returns a DataFrame; all but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variorum import scratch
from variorum.llm import decontaminate, minhash, mixing, pii, quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# a caller has a secret; the registered pipeline needs one that everybody knows
KEY = b"the key of the registered pipeline"


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that break one go."""
    return docs.filter(quality.verdict(F.col("text"))["kept"]).select(*COLUMNS)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup on five-word shingles: one document of each group stays; a row without an id goes."""
    kept = minhash.near_duplicates(docs).filter("kept").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(*COLUMNS)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold an item go."""
    leaks = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms in place of personal values."""
    out = pii.pseudonyms(docs, KEY).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of sources holds, beside the document; the mix is left in a folder `mix-*`.

    Rows that repeat an id share one answer, that of the row with most words; a row without an id goes.
    """
    found = mixing.mix(docs, out=f"{scratch.folder(spark)}/mix-{uuid.uuid4().hex}")
    taken = found.groupBy("doc_id").agg(F.max(F.struct("size", "taken", "source_size", "target")).alias("x"))
    return docs.join(taken, "doc_id").select(*COLUMNS, *(F.col(f"x.{c}") for c in ("size", "source_size", "target", "taken")))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good),
    ("minhash_near_dedup", unlike),
    ("benchmark_decontamination", unseen),
    ("pii_pseudonyms", private),
    ("mix_sources", mixed),
]
# the latent retrieval, the Feistel permutations and the text they change are not SQL; tests hold them against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, each but the last written and read again in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch.folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
