"""Cross-tokenizer alignment: where the tokens of two vocabularies end together.

Both token sequences of a text are laid over its bytes.  Their cumulative ends go into
end-to-index dictionaries; the keys that both have, sorted, slice the two id lists into
groups, and each slice is expanded into its links.  A pair of linked tokens ends at the same
byte, so one is the end of the other; how many such pairs there are follows from the two
vocabularies alone (`linkable`), whatever the corpus, and that bounds what is counted,
gathered and sent along.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter as Multiset
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variorum.llm import store, words

# fixed value: the pattern that cuts a text before byte-level merges
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Align:
    """The folder of the two vocabulary files, read on the driver and sent along (some megabytes, whatever the corpus).

    `ends` is how many bytes of a text one pair of dictionaries covers.
    """

    folder: str = "/opt/tokenizers"
    byte_file: str = "byte_bpe_50k.json"
    piece_file: str = "piece_bpe_32k.model"
    ends: int = 1 << 20


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass(frozen=True)
class Files:
    """The contents of the two vocabulary files."""

    byte_bpe: bytes = field(repr=False)
    piece_bpe: bytes = field(repr=False)


_NONE = np.zeros(0, np.int64)


class Encoders:
    """Both encoders with the bytes of every token."""

    def __init__(self, files: Files):
        import sentencepiece
        import tiktoken

        model = json.loads(files.byte_bpe)
        letters = _byte_letters()
        special = {x["id"] for x in model["added_tokens"]}
        vocabulary = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if i not in special}
        # merges in order of id are ranks, which the faster library takes; ids are the same, as tests hold
        for i, merge in enumerate(model["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if vocabulary[bytes(letters[c] for c in a + b)] != 256 + i:
                raise ValueError("merges and ids of the byte-level vocabulary differ in order")
        self._byte = tiktoken.Encoding("byte", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        self._piece = sentencepiece.SentencePieceProcessor(model_proto=files.piece_bpe)
        self.bytes_a = [b""] * (max(model["model"]["vocab"].values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = token
        self.bytes_b = [self._piece_bytes(i) for i in range(self._piece.get_piece_size())]
        self.width = max(len(self.bytes_a), len(self.bytes_b))
        self.spelled = np.array([f"{i}{mark}" for mark in ",|,;" for i in range(self.width)], object)
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))

    def _piece_bytes(self, i: int) -> bytes:
        if self._piece.is_control(i) or self._piece.is_unknown(i):
            return b""
        piece = self._piece.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self._piece.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The two id lists; none where the text is empty or either does not spell a space and the text.

        Byte-level tokens are pieces of the text's bytes, so their length tells; pieces are compared.
        """
        if not text:
            return _NONE, _NONE
        raw = f" {text}".encode()
        pieces = self._piece.encode(text, num_threads=1)
        if b"".join(map(self.bytes_b.__getitem__, pieces)) != raw:
            return _NONE, _NONE
        a = np.array(self._byte.encode_ordinary(f" {text}"), np.int64)
        return (a, np.array(pieces, np.int64)) if self.size_a[a].sum() == len(raw) else (_NONE, _NONE)


@lru_cache(maxsize=2)
def _encoders(files: Files) -> Encoders:
    return Encoders(files)


def vocabularies(p: Align) -> Files:
    with open(f"{p.folder}/{p.byte_file}", "rb") as a, open(f"{p.folder}/{p.piece_file}", "rb") as b:
        return Files(a.read(), b.read())


def linkable(e: Encoders) -> int:
    """How many pairs of ids can end together at all: one token is the end of the other."""
    first, second = set(e.bytes_a), Multiset(e.bytes_b)
    return sum(second[t[k:]] for t in e.bytes_a for k in range(len(t))) + sum(t[k:] in first for t in e.bytes_b for k in range(1, len(t)))


def groups(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """After how many tokens of a and of b both have ended at the same byte; the last are the two lengths."""
    ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    after_a: list[int] = []
    after_b: list[int] = []
    for low in range(0, int(ends_a[-1]) if len(a) else 0, block):
        (i, j), (k, m) = (np.searchsorted(x, [low, low + block], "right") for x in (ends_a, ends_b))
        at_a = dict(zip(ends_a[i:j].tolist(), range(i + 1, j + 1)))
        at_b = dict(zip(ends_b[k:m].tolist(), range(k + 1, m + 1)))
        common = sorted(at_a.keys() & at_b.keys())
        after_a.extend(map(at_a.__getitem__, common))
        after_b.extend(map(at_b.__getitem__, common))
    return np.array(after_a, np.int64), np.array(after_b, np.int64)


def _spelled(a: np.ndarray, b: np.ndarray, after_a: np.ndarray, after_b: np.ndarray, table: np.ndarray, width: int) -> str:
    """The groups as text: each slice's ids of a, a bar, its ids of b; `table` holds each id with each mark behind it."""
    n_a, n_b = np.diff(after_a, prepend=0), np.diff(after_b, prepend=0)
    out = np.empty(len(a) + len(b), np.int64)
    # an id of a stands behind all of b before its slice, one of b behind all of a up to its slice's end
    out[np.arange(len(a)) + np.repeat(after_b - n_b, n_a)] = a
    out[np.arange(len(b)) + np.repeat(after_a, n_b)] = b + 2 * width
    out[after_a - 1 + after_b - n_b] += width
    out[after_a - 1 + after_b] += width
    return "".join(table[out].tolist())[:-1]


class Counter:
    """How often each code was seen; grows with the distinct codes only."""

    def __init__(self, most: int = 1 << 20):
        self.most, self.held, self.waiting = most, [], 0
        self.codes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, codes: np.ndarray) -> None:
        self.held.append(codes)
        self.waiting += len(codes)
        if self.waiting >= self.most:
            self.settle()

    def settle(self) -> None:
        code, n = np.unique(np.concatenate([*self.held, np.zeros(0, np.int64)]), return_counts=True)
        every = np.concatenate([self.codes, code])
        self.codes, at = np.unique(every, return_inverse=True)
        total = np.zeros(len(self.codes), np.int64)
        np.add.at(total, at, np.concatenate([self.counts, n]))
        self.counts, self.held, self.waiting = total, [], 0


_SCHEMA = "is_doc boolean, id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, code long, n long"


def _aligned(batches: Iterator[pa.RecordBatch], files: Files, p: Align) -> Iterator[pa.RecordBatch]:
    """A row for every document, and after them one for every pair of ids linked in the task."""
    e = _encoders(files)
    width = len(e.bytes_b)
    seen = Counter()
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    types = [pa.bool_(), *[pa.int64()] * 4, pa.string(), pa.binary(), pa.int64(), pa.int64()]
    for batch in words.slices(batches, "text"):
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = e.encode(text or "")
            after = groups(a, b, e.size_a, e.size_b, p.ends)
            # tokens have bytes, so of a slice's pairs only the last tokens end together
            code = a[after[0] - 1] * width + b[after[1] - 1]
            seen.add(code)
            digest = hashlib.sha256(_spelled(a, b, *after, e.spelled, e.width).encode()).hexdigest() if len(code) else ""
            rows.append((True, doc, len(a), len(b), len(code), digest, code.astype(np.uint32).tobytes(), None, None))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
    seen.settle()
    n = len(seen.codes)
    if n:
        none = [pa.nulls(n, t) for t in types[1:7]]
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, bool)), *none, pa.array(seen.codes), pa.array(seen.counts)], names=names)


def _scored(batches: Iterator[pa.RecordBatch], codes: np.ndarray, counts: np.ndarray, best: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each document's links under the counts of the whole corpus."""
    for batch in batches:
        total, top = [], []
        for links in batch.column(5):
            at = np.searchsorted(codes, np.frombuffer(links.as_buffer(), np.uint32).astype(np.int64))
            total.append(int(counts[at].sum()))
            top.append(int(best[at].sum()))
        links = [len(x.as_buffer()) // 4 for x in batch.column(5)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(4)), *(pa.array(x, pa.int64()) for x in (links, top, total)), batch.column(4)],
            names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
        )


def aligned(docs: DataFrame, params: Align | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents (id, n_a, n_b, n_groups, groups_sha256, links) and pairs (a, b, n, best): the alignment, once over the texts.

    `links` holds the codes of a document's linked pairs, a * size of the second vocabulary + b, as 32-bit numbers;
    `n` is how many links of the corpus have the pair, `best` whether no pair of its b has more.
    """
    p = params or Align()
    files = vocabularies(p)
    e = _encoders(files)
    if len(e.bytes_a) * len(e.bytes_b) >= 1 << 32:
        raise ValueError("pairs of these vocabularies do not fit in 32 bits")
    width = len(e.bytes_b)
    sent = docs.sparkSession.sparkContext.broadcast(files)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    both = store.cut(rows.mapInArrow(lambda b: _aligned(b, sent.value, p), _SCHEMA))
    pairs = both.filter("not is_doc").groupBy("code").agg(F.sum("n").alias("n"))
    pairs = pairs.select(F.floor(F.col("code") / F.lit(float(width))).cast("long").alias("a"), (F.col("code") % width).alias("b"), "n")
    top = pairs.groupBy("b").agg(F.max("n").alias("most"))
    pairs = store.cut(pairs.join(top, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")))
    return both.filter("is_doc").select("id", "n_a", "n_b", "n_groups", "groups_sha256", "links"), pairs


def alignment(docs: DataFrame, params: Align | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per row of `docs`.

    A space and the text is encoded by the first vocabulary, the text by the second, which adds
    the space.  A null or empty text, and one that either encoding does not spell byte by byte,
    has no tokens: zeros, and an empty digest.  Strings of special tokens are plain text.
    Repeated rows are documents of their own and count; a null id is kept.  Other columns are
    not read.  What comes to the driver is a row per pair of ids linked somewhere: at most
    `linkable`, a number of the vocabularies.
    """
    p = params or Align()
    spark: SparkSession = docs.sparkSession
    found, pairs = aligned(docs, p, id_col, text_col)
    width = len(_encoders(vocabularies(p)).bytes_b)
    table = pairs.select((F.col("a") * width + F.col("b")).alias("code"), "n", "best").toArrow().sort_by("code").combine_chunks()
    sent = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("code", "n", "best")))
    out = found.select("id", "n_a", "n_b", "n_groups", "groups_sha256", "links").mapInArrow(
        lambda b: _scored(b, *sent.value), "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
    return out.withColumnRenamed("id", id_col)
