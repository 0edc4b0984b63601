"""Word hashes: words and sequences that cancel in polynomials modulo a power of two must differ."""

import numpy as np
import pyarrow as pa
import pytest

from variorum.llm import decontaminate, minhash, substrings, words


def alternating(n):
    """The Thue-Morse word of n letters, and the same with both letters swapped."""
    a = "a"
    while len(a) < n:
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_words_differ(n):
    w = words.cut(pa.array(list(alternating(n))))
    for base in words.BASES:
        a, b = w.hash(base)
        assert a != b


def test_sequences_differ():
    a, b = (list(x) for x in alternating(4096))
    w = words.cut(pa.array([" ".join(a), " ".join(b)]))
    for base in words.BASES:
        x, y = words.spans_hash(w.hash(base), np.array([0, 4096]), np.array([4096, 8192]), base)
        assert x != y


def test_hash_depends_on_the_word_alone():
    texts = ["one two three", "three \t two", None, "", "twoo tw\0 tw o", "été one"]
    w = words.cut(pa.array(texts))
    got = {}
    for s, e, h in zip(w.start, w.end, w.hash(), strict=True):
        got.setdefault(w.data[s:e].tobytes(), set()).add(int(h))
    assert all(len(h) == 1 for h in got.values()) and len(set.union(*got.values())) == len(got) == 8


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_documents_of_such_words_are_neither_linked_nor_cut(spark, n):
    a, b = alternating(n)
    frame = " ".join(f"w{i % 3}" for i in range(30))
    docs = spark.createDataFrame([(1, a), (2, b), (3, f"{frame} {a} {frame}"), (4, f"{frame} {b} {frame}")], "doc_id long, text string")
    got = minhash.near_duplicates(docs.filter("doc_id < 3"), params=minhash.MinHash(shingle=2)).collect()
    assert {r["component_id"] for r in got} == {1, 2}
    assert {r["n_removed"] for r in substrings.deduplicated(docs).collect()} == {0}
    items = spark.createDataFrame([(7, f"{a} {b} {a} " * 3 + "the answer")], "item_id long, text string")
    texts = spark.createDataFrame([(1, f"{b} {a} {b} " * 3 + "another end")], "doc_id long, text string")
    assert decontaminate.contaminated(texts, items).isEmpty()
