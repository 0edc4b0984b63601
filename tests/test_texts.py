"""Blocks of many pairs at once against plain difflib."""

import random
from difflib import SequenceMatcher

import pyarrow as pa
import pytest

from variorum.functions import align


def _pairs(rng, n):
    for _ in range(n):
        words = rng.choice((1, 2, 4, 8, 30, 300))
        a = [f"w{rng.randrange(words)}" for _ in range(rng.randrange(90))]
        b = [rng.choice((x, x, x, x, "z", f"w{rng.randrange(words)}")) for x in a if rng.random() > 0.1] if rng.random() < 0.7 else [f"w{rng.randrange(words)}" for _ in range(rng.randrange(90))]
        yield (a, list(a)) if rng.random() < 0.05 else (a, b)


@pytest.mark.parametrize("size", [1, 2000, 1 << 20])
def test_all_pairs_at_once_equal_difflib(monkeypatch, size):
    monkeypatch.setattr(align, "SLICE", size)
    pairs = list(_pairs(random.Random(size), 1500))
    left, right = ([" ".join(p[x]) for p in pairs] for x in (0, 1))
    left[7] = right[11] = left[13] = right[13] = None
    a, b = pa.array(left, pa.string()), pa.array(right, pa.string())
    got = align._by_slices(a, b, align._Texts.opcodes).to_pylist()
    blocks = align._by_slices(a, b, align._Texts.matching).to_pylist()
    ratios = align._by_slices(a, b, align._Texts.ratios).to_pylist()
    for (x, y), l, r, ops, found, ratio in zip(pairs, left, right, got, blocks, ratios, strict=True):
        if l is None or r is None:
            assert ops is found is ratio is None
            continue
        plain = SequenceMatcher(None, x, y, autojunk=False)
        assert [tuple(o.values()) for o in ops] == plain.get_opcodes()
        assert [tuple(o.values()) for o in found] == [tuple(m) for m in plain.get_matching_blocks()[:-1]]
        assert ratio == (plain.ratio() if x and y else 0.0)


def test_folded_words_match():
    a, b = pa.array(["été à la mer — ☃ fin", ""]), pa.array(["ete a la mer – ☂ fin", "x"])
    got = align._by_slices(a, b, align._Texts.opcodes, fold=True).to_pylist()
    assert [tuple(o.values()) for o in got[0]] == [("equal", 0, 7, 0, 7)]
    assert [tuple(o.values()) for o in got[1]] == [("insert", 0, 0, 0, 1)]


def test_no_pairs():
    none = pa.array([], pa.string())
    assert align._by_slices(none, none, align._Texts.opcodes).to_pylist() == []


def test_ordinary_texts_are_not_searched_one_by_one(monkeypatch):
    monkeypatch.setattr(align, "_search", lambda *_: pytest.fail("searched alone"))
    rng = random.Random(5)
    a = [f"w{rng.randrange(400)}" for _ in range(600)]
    b = [x for x in a if rng.random() > 0.1]
    got = align._by_slices(pa.array([" ".join(a)]), pa.array([" ".join(b)]), align._Texts.opcodes).to_pylist()[0]
    assert [tuple(o.values()) for o in got] == SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
