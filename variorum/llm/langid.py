"""Language identification by compression: the language whose text best predicts a text compresses it best.

Each language has a few zstandard dictionaries of raw content, cut from a bounded sample of
labelled documents.  A text is compressed whole with every dictionary; the language with the
smallest sum of sizes wins, and the answer is rejected when the runner-up is close.  Case is
folded on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNKNOWN = "und"


@dataclass(frozen=True)
class Languages:
    """The sample: at most `sample` documents a language, of each at most `share` bytes so that
    no long one fills it, `parts` dictionaries of `part_bytes`.

    A margin under `narrow` (of the runner-up's size) is rejected.
    """

    sample: int = 300
    share: int = 2048
    parts: int = 2
    part_bytes: int = 1 << 17
    level: int = 6
    narrow: float = 0.01


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of the sample: its id's CRC modulo 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, p: Languages, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, list[bytes]]:
    """The dictionaries of each language, most frequent first; only labelled documents that are not held out are looked at."""
    known = docs.filter(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    # ids first, so that only the few chosen texts are read
    row = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    chosen = known.select("id", "lang").withColumn("row", row).filter(F.col("row") <= p.sample).select("id", "lang").toArrow()
    ids = docs.sparkSession.createDataFrame(chosen) if chosen.num_rows else None
    texts: dict[str, list[tuple[int, bytes]]] = {k: [] for k in counts}
    if ids is not None:
        share = F.encode(F.lower(F.substring("text", 1, p.share)), "utf-8")
        for r in known.join(ids, ["id", "lang"], "left_semi").select("id", "lang", share.alias("text")).toArrow().to_pylist():
            texts[r["lang"]].append((r["id"], r["text"][: p.share]))
    out = {}
    for lang in sorted(counts, key=lambda x: (-counts[x], x)):
        parts = [b" ".join(t for _, t in sorted(texts[lang])[k :: p.parts])[: p.part_bytes] for k in range(p.parts)]
        out[lang] = [x for x in parts if len(x) >= 8]  # zstandard takes no shorter content
    return {k: v for k, v in out.items() if v}


def _classify(batches: Iterator[pa.RecordBatch], model: dict[str, list[bytes]], p: Languages) -> Iterator[pa.RecordBatch]:
    import zstandard

    packers: list[tuple[str, list]] = []
    for lang, parts in model.items():
        own = []
        for content in parts:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=p.level)
            own.append(zstandard.ZstdCompressor(level=p.level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        packers.append((lang, own))
    for batch in batches:
        best, score, second, narrow = [], [], [], []
        for text in batch.column(1).to_pylist():
            if not packers or text is None or not any(c.isalpha() for c in text):
                row = (UNKNOWN, 0.0, None, True)
            else:
                raw = text.lower().encode()
                # ties go to the more frequent language, then by code point
                sizes = [(sum(len(c.compress(raw)) for c in own) / len(own), k) for k, (_, own) in enumerate(packers)]
                (small, k), *rest = sorted(sizes)
                margin = (rest[0][0] - small) / rest[0][0] if rest else 1.0
                row = (packers[k][0], margin, packers[rest[0][1]][0] if rest else None, margin < p.narrow)
            for x, y in zip((best, score, second, narrow), row, strict=True):
                x.append(y)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(second, pa.string()), pa.array(narrow, pa.bool_())],
            names=["id", "best", "score", "second", "rejected"],
        )


def classified(docs: DataFrame, model: dict[str, list[bytes]], params: Languages | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, best, score, second, rejected: one row per row of `docs`, from the text alone.

    `score` is how much smaller the best size is than the runner-up's, 0 to 1.  A null text or one
    without a letter is `und`, score 0, rejected; so is every text if nothing was learned.
    Repeated rows are judged alike; other columns are not read.
    """
    p = params or Languages()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, best string, score double, second string, rejected boolean"
    return rows.mapInArrow(lambda b: _classify(b, model, p), schema).withColumnRenamed("id", id_col)
