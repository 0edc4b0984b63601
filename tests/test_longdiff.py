"""Diff of long texts: equal to the whole alignment where that is small, a valid diff everywhere."""

import random
from difflib import SequenceMatcher

import pytest

from variorum.operators import longdiff


def whole(a, b):
    return [(i1, i2, j1, j2, t, " ".join(a[i1:i2]), " ".join(b[j1:j2])) for t, i1, i2, j1, j2 in SequenceMatcher(None, a, b, False).get_opcodes() if t != "equal"]


def parts_of(rng, key, side, words, most=40):
    out, at, n = [], 0, 0
    while at < len(words):
        to = min(len(words), at + rng.randint(0, most))
        out.append((key, side, n, words[at:to]))
        at, n = to, n + 1
    return out or [(key, side, 0, [])]


def edited(rng, words, share):
    out = []
    for w in words:
        x = rng.random()
        if x < share:
            out.append(w + "x")
        elif x < 1.5 * share:
            pass
        elif x < 2 * share:
            out += ["new" + str(rng.randint(0, 99)), w]
        else:
            out.append(w)
    return out


def run(spark, texts, p):
    rng = random.Random(1)
    rows = [r for key, (a, b) in texts.items() for s, t in (("a", a), ("b", b)) for r in parts_of(rng, key, s, t)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, side string, part_no int, words array<string>")
    got = {key: [] for key in texts}
    for r in longdiff.changes(df, ["k"], p).collect():
        got[r["k"]].append((r["i1"], r["i2"], r["j1"], r["j2"], r["tag"], r["t1"], r["t2"]))
    return {k: sorted(v) for k, v in got.items()}


def replay(a, b, ops):
    """Side b made from side a and the changes; words may be left out of a change that was not aligned."""
    out, at, to = [], 0, 0
    for i1, i2, j1, j2, tag, t1, t2 in ops:
        assert i1 >= at and j1 - to == i1 - at and a[at:i1] == b[to:j1]
        assert tag == ("insert" if i1 == i2 else "delete" if j1 == j2 else "replace")
        assert t1 is None or (t1, t2) == (" ".join(a[i1:i2]), " ".join(b[j1:j2]))
        out += a[at:i1] + b[j1:j2]
        at, to = i2, j2
    assert out + a[at:] == b


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base = say(3000)
    half = say(700), say(700)
    return {
        "sparse": (base, edited(rng, base, 0.01)),
        "dense": (t := say(900), edited(rng, t, 0.2)),
        "same": (base, base),
        "swapped": (half[0] + half[1], half[1] + half[0]),
        "moved line": (base, base[:5] + base[2990:] + base[5:2990]),
        "unlike": (say(600), ["z" + w for w in say(700)]),
        "cut out": (base, base[:100] + base[2500:]),
        "only a": (say(50), []),
        "only b": ([], say(50)),
        "none": ([], []),
        "loop": (["x", "y"] * 400, ["x", "y"] * 380 + ["z"]),
        "small": (say(30), say(3)),
    }


def test_one_piece_is_the_whole_alignment(spark, texts):
    small = {k: (a[:400], b[:400]) for k, (a, b) in texts.items()}
    got = run(spark, small, longdiff.Long(block=4096, chunk=1 << 20, longest=1 << 20))
    assert got == {k: whole(a, b) for k, (a, b) in small.items()}


@pytest.mark.parametrize("p", [longdiff.Long(block=64, chunk=100, longest=300), longdiff.Long(block=16, chunk=32, longest=64, grams=(3,))])
def test_pieces_are_a_diff(spark, texts, p):
    got = run(spark, texts, p)
    for k, (a, b) in texts.items():
        replay(a, b, got[k])
    assert got["same"] == got["none"] == []
    assert got["only a"] == [(0, 50, 0, 0, "delete", " ".join(texts["only a"][0]), "")]
    # where the changes are few, cutting costs nothing
    assert got["sparse"] == whole(*texts["sparse"]) and got["moved line"] == whole(*texts["moved line"])
    assert len(got["cut out"]) == 1
    # one half of a swap stays: the chain takes one diagonal whole
    assert 700 <= sum(i2 - i1 for i1, i2, *_ in got["swapped"]) <= 700 + (4 if len(p.grams) > 1 else p.longest)


def test_chain_is_the_heaviest():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(0, 9)
        js, runs, i = rng.sample(range(n), n), [], 0
        for j in js:
            size = rng.randint(1, 5)
            runs.append((i, 10 * j, size))
            i += size + rng.randint(0, 2)
        best = 0
        for mask in range(1 << n):
            some = [r for k, r in enumerate(runs) if mask >> k & 1]
            if all(x[1] + x[2] <= y[1] for x, y in zip(some, some[1:])):
                best = max(best, sum(r[2] for r in some))
        got = longdiff.chain(rng.sample(runs, n))
        assert sum(r[2] for r in got) == best and all(x[0] + x[2] <= y[0] and x[1] + x[2] <= y[1] for x, y in zip(got, got[1:]))


def test_without_keys(spark):
    df = spark.createDataFrame([("a", 1, ["x", "y"]), ("a", 2, ["z"]), ("b", 7, ["x", "q", "z"])], "side string, n int, words array<string>")
    assert [tuple(r) for r in longdiff.changes(df, [], order="n").collect()] == [(1, 2, 1, 2, "replace", "y", "q")]
    assert longdiff.changes(df.limit(0), [], order="n").isEmpty()
