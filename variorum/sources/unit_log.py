"""Raw unit logs: the append-only text files a reader writes, one block per unit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variorum.functions import text as T
from variorum.functions.predicates import strip_allcaps, strip_headers

START = "<<< SPREAD_START "
END = "<<< SPREAD_END >>>"
HEAD_RE = r'^pdf="([^"]+)" spread="(\d+)"(?: total="(\d+)")?[^>]*>>>'
RULE = "━" * 60


def existing(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], DataFrame]:
    """The paths that exist, and an audit row for each that does not."""
    jvm = spark._jvm
    found, missing = [], []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        hit = fs.globStatus(path)
        (found if hit is not None and len(hit) else missing).append(p)
    audit = spark.createDataFrame([("scan", "missing_file", p) for p in missing], "op string, action string, reason string")
    return found, audit


def _parsed(record: Column) -> list[Column]:
    head = [F.regexp_extract(record, HEAD_RE, i) for i in (1, 2, 3)]
    body = F.regexp_replace(record, HEAD_RE, "")
    end = F.locate(END, body)
    return [
        head[0].alias("book"),
        head[1].try_cast("int").alias("unit_no"),
        F.nullif(head[2], F.lit("")).try_cast("int").alias("total"),
        F.when(end > 0, F.btrim(body.substr(F.lit(1), end - 1), F.lit(" \n\r\t"))).alias("content"),
    ]


def read_blocks(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every block with its place in the file; ``content`` is null where the block was never closed.

    The start marker is the record separator, so a log of any size splits across
    tasks and no task holds more than its own blocks.
    """
    raw = spark.read.option("lineSep", START).text(list(paths))
    raw = raw.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_modification_time").alias("written"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"),
        ).alias("place"),
    )
    return raw.filter(F.col("value").rlike(HEAD_RE)).select(*_parsed(F.col("value")), "file", "place")


def parse_log(logs: DataFrame, log: str, carry: Sequence[str] = ()) -> DataFrame:
    """S1 over a column that already holds whole logs (one row per log)."""
    parts = logs.select(*carry, F.posexplode(F.split(F.col(log), START)).alias("place", "value"))
    return parts.filter(F.col("value").rlike(HEAD_RE)).select(*carry, *_parsed(F.col("value")), "place")


def complete_units(blocks: DataFrame, by: Sequence[str] = ("book", "unit_no")) -> DataFrame:
    """Closed blocks, the last of a repeated key wins: the file written last, and the later place in it."""
    closed = blocks.filter(F.col("content").isNotNull())
    return closed.groupBy(*by).agg(F.max_by(F.struct("total", "content"), "place").alias("v")).select(*by, "v.*")


def unterminated(blocks: DataFrame) -> DataFrame:
    """Audit rows for blocks that were never closed."""
    return blocks.filter(F.col("content").isNull()).select(
        F.lit("scan").alias("op"), F.lit("unterminated").alias("action"),
        F.concat_ws(" ", F.col("book"), F.lit("unit"), F.col("unit_no").cast("string")).alias("reason"),
    )


def skip_leading(units: DataFrame, book: str, n: int) -> DataFrame:
    """S3: the first n units of one book carry no body text."""
    return units.filter(~((F.col("book") == book) & (F.col("unit_no") <= n)))


def reference_text(content: Column, titles: tuple[str, ...], page_markers: bool = False, allcaps: bool = False) -> Column:
    """S3: unit text with running titles (and, if asked, page markers and capital lines) removed."""
    edge = F.lit(" \n\r\t")
    t = F.btrim(strip_headers(content, titles), edge)
    if page_markers:
        t = F.btrim(F.regexp_replace(t, r"\[Page (\d+)\]", ""), edge)
    if allcaps:
        t = F.btrim(strip_allcaps(t), edge)
    return t


def page_index(units: DataFrame, book: Sequence[str] = ("book",)) -> DataFrame:
    """S3: page number to unit, the last unit naming a page wins; ``n_claims`` counts the claims."""
    nums = F.transform(F.regexp_extract_all("content", F.lit(r"\[Page (\d+)\]"), F.lit(1)), lambda x: x.try_cast("int"))
    claims = units.select(*book, "unit_no", F.explode(nums).alias("page_number"))
    return claims.groupBy(*book, "page_number").agg(F.max("unit_no").alias("unit_no"), F.count("*").alias("n_claims"))


def format_block(book: Column, unit_no: Column, total: Column, content: Column) -> Column:
    """One closed block as it is appended to a log."""
    head = F.format_string('\n<<< SPREAD_START pdf="%s" spread="%d" total="%d" >>>\n', book, unit_no, total)
    return F.concat(head, F.btrim(content, F.lit(" \n\r\t")), F.lit(f"\n{END}\n"))


def append_units(units: DataFrame, path: str) -> None:
    """Append finished units to a log directory."""
    rows = units.select(format_block(F.col("book"), F.col("unit_no"), F.col("total"), F.col("content")).alias("value"))
    rows.write.mode("append").option("lineSep", "\n").text(path)


def replace_units(units: DataFrame, new: DataFrame, keys: Sequence[str] = ("book", "unit_no")) -> DataFrame:
    """Keyed update of the content of units that exist; others are left alone."""
    fresh = new.select(*keys, F.col("content").alias("_new"))
    joined = units.join(fresh, list(keys), "left")
    return joined.withColumn("content", F.coalesce("_new", "content")).withColumn("replaced", F.col("_new").isNotNull()).drop("_new")


def positional_results(requests: DataFrame, results: DataFrame, order: Sequence[str], ordinal: str = "ordinal") -> DataFrame:
    """The i-th result belongs to the i-th request of its batch; empty results are kept as null.

    A batch is one call to a reader, so its requests fit one window.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("batch").orderBy(*order)
    numbered = requests.withColumn(ordinal, F.row_number().over(w) - 1)
    got = results.select("batch", F.posexplode("texts").alias(ordinal, "content"))
    return numbered.join(got, ["batch", ordinal], "left").withColumn("content", F.nullif(F.trim("content"), F.lit("")))


def read_flat_output(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The prototype's flat output, a ruled header before every unit."""
    raw = spark.read.option("lineSep", f"{RULE}\n  Source: ").text(list(paths))
    return parse_flat(raw, "value")


def parse_flat(records: DataFrame, record: str, carry: Sequence[str] = ()) -> DataFrame:
    """S23 over records that already begin after the rule."""
    head = rf"^(.+?)  \|  Spread (\d+)/(\d+)\n{RULE}\n"
    r = F.col(record)
    body = F.regexp_replace(F.regexp_replace(r, head, ""), r"\n═{60}\nEND OF TEXT(?s:.*)$", "")
    return records.filter(r.rlike(head)).select(
        *carry,
        F.regexp_extract(r, head, 1).alias("book"),
        F.regexp_extract(r, head, 2).try_cast("int").alias("unit_no"),
        F.regexp_extract(r, head, 3).try_cast("int").alias("total"),
        F.btrim(body, F.lit(" \n\r\t")).alias("content"),
    )


def latest_version(names: DataFrame, name: str, group: Sequence[str]) -> DataFrame:
    """The file name with the highest numeric suffix; names without one count as 0."""
    suffix = F.coalesce(F.regexp_extract(name, r"-(\d+)\.[a-z]+$", 1).try_cast("int"), F.lit(0))
    return names.groupBy(*group).agg(F.max_by(name, F.struct(suffix, name)).alias("latest"), F.max(suffix).alias("version"))


def stream_offsets(units: DataFrame, tokens: Column, group: Sequence[str], order: str, width: int) -> DataFrame:
    """Where each unit's tokens sit in the concatenated stream of its group.

    The stream itself is never built: a unit carries its start offset, so any
    slice of the stream is a range of units.
    """
    from variorum.operators import ordered

    sized = units.withColumn("n_tokens", F.size(tokens))
    sized = ordered.with_bucket(sized, order, width)
    return ordered.running_sum(sized, group, [order], F.col("n_tokens"), "start_token", "bucket").drop("bucket")


