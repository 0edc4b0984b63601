"""Blocks by runs against plain difflib, on texts of every degree of repetition."""

import random
from difflib import SequenceMatcher

from variorum.functions import align


def test_runs_equal_difflib():
    rng = random.Random(1)
    for _ in range(3000):
        words = rng.choice((1, 2, 4, 8, 30))
        a = [f"w{rng.randrange(words)}" for _ in range(rng.randrange(70))]
        b = [x for x in a if rng.random() > 0.1] if rng.random() < 0.6 else [f"w{rng.randrange(words)}" for _ in range(rng.randrange(70))]
        plain, fast = SequenceMatcher(None, a, b, autojunk=False), align._Runs(a, b)
        assert fast.get_opcodes() == plain.get_opcodes()
        assert fast.get_matching_blocks() == plain.get_matching_blocks()
        assert fast.ratio() == plain.ratio()


def test_runs_of_repeated_lines():
    """Such texts have too many equal triples; they are not left to the scan of every part."""
    rng = random.Random(2)
    line = [f"w{i}" for i in range(25)]
    a = line * 40
    b = [x if rng.random() > 0.03 else "y" for x in a if rng.random() > 0.02]
    assert align._runs(a, b, 3) is None
    plain = SequenceMatcher(None, a, b, autojunk=False)
    assert align._Runs(a, b).get_opcodes() == plain.get_opcodes()


def test_each_part_is_not_scanned_anew(monkeypatch):
    """Ordinary text is searched once, not once per block."""
    calls = []
    monkeypatch.setattr(align._Matcher, "find_longest_match", lambda *_: calls.append(1))
    rng = random.Random(3)
    a = [f"w{rng.randrange(400)}" for _ in range(600)]
    b = [x for x in a if rng.random() > 0.1]
    assert align._matcher(" ".join(a), " ".join(b)).get_opcodes() == SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
    assert not calls
