"""Token alignment, phrase mining and HTML extraction against plain versions, on small tables with all sorts of odd rows."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from variorum.llm import pagetext, phrases, tokens

CLASH = ("id", "n", "a", "b", "k", "ws", "links", "code", "text2", "host", "salt", "blocks", "inside", "rank", "phrase", "is_doc", "prefix", "key")


def clashing(df):
    for c in CLASH:
        df = df.withColumn(c, F.lit("mine"))
    return df


# --- alignment of two vocabularies


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    letters = "abcdefgh éßñ日本\t\n ▁.,'0123<|>\U0001f600"
    out = ["Hello world, it's 2024.", "", None, " ", "  two  spaces\n\n", "<|endoftext|> and <s> are text </s><unk>", "a▁b", "ﬁ½ \x00 \x85", "Hello world, it's 2024.", "x" * 5000, "été " * 400]
    return out + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 120))) for _ in range(60)]


def plain_alignment(texts, folder):
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
    letter = tokens._byte_letters()
    found = []
    for t in texts:
        ids = ([], []) if not t else (first.encode(" " + t, add_special_tokens=False).ids, second.encode(t))
        a = [bytes(letter[c] for c in first.id_to_token(i)) for i in ids[0]]
        b = [bytes([int(second.id_to_piece(i)[3:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
        if not t or b"".join(a) != (" " + t).encode() or b"".join(b) != (" " + t).encode():
            found.append(([], [], [], []))
            continue
        ends = [[sum(map(len, x[: i + 1])) for i in range(len(x))] for x in (a, b)] if len(t) < 2000 else [list(np.cumsum([len(y) for y in x])) for x in (a, b)]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, links, i, j = [], [], 0, 0
        for end in common:
            x, y = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(f"{','.join(map(str, ids[0][i:x]))}|{','.join(map(str, ids[1][j:y]))}")
            links += [(p, q) for p, u in zip(ids[0][i:x], ends[0][i:x]) for q, v in zip(ids[1][j:y], ends[1][j:y]) if u == v]
            i, j = x, y
        found.append((*ids, groups, links))
    count = Counter(x for f in found for x in f[3])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return [
        (len(a), len(b), len(g), len(k), sum(count[x] == top[x[1]] for x in k), sum(count[x] for x in k), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for a, b, g, k in found
    ]


@pytest.mark.parametrize("ends", [1 << 20, 7])
def test_alignment(spark, texts, ends):
    p = tokens.Align(ends=ends)
    df = clashing(spark.createDataFrame([(i if i != 3 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3))
    got = {r["doc_id"]: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in tokens.alignment(df, p).collect()}
    want = plain_alignment(texts, p.folder)
    assert got == {i if i != 3 else None: w for i, w in enumerate(want)}
    assert want[1] == want[2] == want[6] == (0, 0, 0, 0, 0, 0, "") and want[5][0] > 10


def test_every_linked_pair_is_linkable(spark, texts):
    p = tokens.Align()
    e = tokens._encoders(tokens.vocabularies(p))
    pairs = tokens.aligned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), p)[1].collect()
    assert pairs and all(e.bytes_a[r["a"]].endswith(e.bytes_b[r["b"]]) or e.bytes_b[r["b"]].endswith(e.bytes_a[r["a"]]) for r in pairs)
    assert len(pairs) <= tokens.linkable(e) < 2_000_000


def test_alignment_of_nothing(spark):
    assert tokens.alignment(spark.createDataFrame([], "doc_id long, text string")).isEmpty()


# --- phrases


def plain_phrases(rows, p):
    words, count = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, p.longest + 1):
                count.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    often = {x: n for x, n in count.items() if n >= p.least}
    out = []
    for (lang, ws), a in often.items():
        if len(ws) < 2 or any(x == lang and len(y) > len(ws) and n >= a and any(y[i : i + len(ws)] == ws for i in range(len(y))) for (x, y), n in often.items()):
            continue
        cut = min((Fraction(1000 * a * words[lang], count[lang, ws[:k]] * count[lang, ws[k:]]).__floor__(), k) for k in range(1, len(ws)))
        out.append((lang, " ".join(ws), a, count[lang, ws[: cut[1]]], count[lang, ws[cut[1] :]], words[lang], cut[0]))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(mine[: p.report])]
    return Counter(ranked)


@pytest.mark.parametrize("p", [phrases.Mining(least=4, report=15), phrases.Mining(least=3, report=2000, burst=8, most=64, batch=32, fan=2), phrases.Mining(least=1, longest=3)])
def test_phrases(spark, p):
    rng = random.Random(5)
    fixed = ["New York City", "as well as", "x y x y x y", "Ärzte ohne grenzen", "a\tb  c", "same same same same"]
    rows = [(None, None), ("en", None), ("en", ""), ("en", " .,;\n"), ("und", "new york city " * 3), (None, "new york city."), ("en", "one two " * 400)]
    for _ in range(60):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice("abcdefg") for _ in range(rng.randint(1, 40))]
        rows.append((rng.choice(["en", "de", None]), "".join(x + rng.choice([" ", " ", " ", ", ", ".\n", "\x0b", " "]) for x in parts)))
    rows += rows[-3:]
    df = clashing(spark.createDataFrame(rows, "lang string, text string").repartition(3))
    got = Counter(tuple(r) for r in phrases.collocations(df, p).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == plain_phrases(rows, p)


def test_trie_counts_and_spills():
    p = phrases.Mining(burst=16, most=128, batch=64, fan=4)
    rng = np.random.default_rng(1)
    trie, out, want = phrases.HatTrie(3, p), Counter(), Counter()

    def take(runs):
        for columns, n in runs:
            assert len(n) and (np.diff(phrases._fold(columns).astype(object)) >= 0).all()
            for *row, k in zip(*columns, n, strict=True):
                out[tuple(map(int, row))] += int(k)

    spilled = 0
    for _ in range(40):
        rows = [rng.integers(0, hi, 50).astype(np.uint64) for hi in (2, 6, 6, 6)]
        want.update(zip(*(map(int, c) for c in rows), strict=True))
        before = sum(out.values())
        take(trie.add(rows))
        spilled += sum(out.values()) > before
        assert sum(trie.size.values()) <= p.most
    assert spilled and len(trie.inner) > 1
    take(trie.spill())
    assert out == want and not trie.leaves


def test_score_is_exact_beyond_64_bits(spark):
    a, n, left, right = 10**13 + 7, 10**14 + 9, 10**13 + 8, 10**13 + 11
    df = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert df.select(phrases._score(*map(F.col, "anlr"))).first()[0] == 1000 * a * n // (left * right)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).isEmpty()


# --- main text of pages


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("just  text &amp; more&nbsp;of it", "just text & more of it"),
        ("<html><head><title>t</title><style>p{}</style></head><body><nav>menu</nav><p>One<p>two <b>bold<br>three</body>", "One two bold three"),
        ('<article><h1>A</h1><script>var t="</p><article>";</script><p>x<!-- <p>no</p> --> y</p></article><footer>f</footer>', "A x y"),
        ('<p>outside</p><article><header><h1>Head</h1></header><p>in</p><aside>no</aside><form>no<input></form></article>', "Head in"),
        ('<header>site</header><main><div class="post">a</div><div class="comments"><article>a comment</article></div></main>', "a"),
        ('<div id="sidebar-left">s</div><div class="cookie-notice">c</div><div class="body">main</div><p title="a > b">q</p>', "main q"),
        ("<article><p>a < b && c <3</p><ul><li>one</li><li>two</li></ul></article", "a < b && c <3 one two"),
        ('<article>never <i>closed</i><p hidden>no</p><div>&eacute;&#233;&#x1F600;&bogus;', "never closed éé\U0001f600&bogus;"),
        ("<ARTICLE><P CLASS='AD'>no</P>yes<SPAN class=ad>no</SPAN> too</ARTICLE>", "yes too"),
        ("<textarea><article>no</article></textarea><p>yes", "yes"),
    ],
)
def test_blocks(page, want):
    assert " ".join(pagetext.blocks(page or "")[0]) == want


def test_suffix_order():
    rng = np.random.default_rng(0)
    for depth in (1, 2, 3, 5, 8, 13):
        ids = rng.integers(0, 3, 200)
        order, rank = pagetext.suffix_order(ids, depth)
        cut = [tuple(ids[i : i + depth].tolist()) for i in range(len(ids))]
        assert [cut[i] for i in order] == sorted(cut)
        assert all((rank[i] == rank[j]) == (cut[i] == cut[j]) for i in range(0, 200, 7) for j in range(200))


def plain_shared(streams, inside, p):
    """Which words of each page lie in a run of `run` words that enough distinct pages have."""
    kinds = {tuple(s) for s in streams}
    out = []
    for s, x in zip(streams, inside, strict=True):
        need = max(p.least, -(-round(len(kinds) * (p.inside if x else p.outside) * 1e9) // 10**9))
        gone = [False] * len(s)
        for i in range(len(s) - p.run + 1):
            run = tuple(s[i : i + p.run])
            if len(kinds) >= p.least and sum(any(k[j : j + p.run] == run for j in range(len(k))) for k in kinds) >= need:
                gone[i : i + p.run] = [True] * p.run
        out.append([False] * len(s) if x and 2 * sum(gone) >= len(s) else gone)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_shared_words(seed):
    rng = random.Random(seed)
    p = pagetext.Extract(run=3, least=2 + seed % 2)
    frame = [rng.randint(1, 50) for _ in range(8)]
    streams = []
    for _ in range(12):
        own = [rng.randint(1, 9) for _ in range(rng.randint(0, 25))]
        at = rng.randint(0, len(own))
        streams.append(own[:at] + (frame if rng.random() < 0.7 else []) + own[at:])
    streams += streams[:3]
    inside = [hash((seed, tuple(s))) % 2 == 0 for s in streams]
    got = pagetext.shared_words([np.array(s, np.uint64) for s in streams], np.array(inside), p)
    assert [g.tolist() for g in got] == plain_shared(streams, inside, p)


def test_extraction(spark):
    """Shared frames of a host's pages go, unique runs stay; articles that are copies stay whole."""
    rng = random.Random(3)
    say = lambda n: " ".join("".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(n))
    bar, offer, copy = say(12), say(10), say(60)
    rows, want = [], {}
    for i in range(40):  # no article element: only the suffix array knows the frame
        own = say(30)
        rows.append((i, f"http://a.org/{i}", f"<div>{bar}</div><div>{own}</div><div>{offer}</div>"))
        want[i] = own
    for i in range(40, 60):  # a line in most articles of a host
        a, b = say(25), say(25)
        rows.append((i, f"http://b.org/{i}", f"<article><p>{a}</p><p>{offer}</p><p>{b}</p></article><footer>{bar}</footer>"))
        want[i] = f"{a} {b}"
    for i in range(60, 75):  # near copies
        rows.append((i, f"https://c.org/{i}", f"<article><p>{copy}</p><p>{i}</p></article>"))
        want[i] = f"{copy} {i}"
    rows += [(80, None, "<p>no host</p>"), (81, "x", None), (82, "http://a.org/", ""), (None, "http://d.org", "<p>no id"), (83, "http://e.org", "<p>twice"), (83, "http://e.org", "<p>twice")]
    want |= {80: "no host", 81: "", 82: "", None: "no id", 83: "twice"}
    df = clashing(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).drop("text2")
    for p in (pagetext.Extract(), pagetext.Extract(cell=1 << 14)):
        got = pagetext.extracted(df, p).collect()
        assert len(got) == len(rows) and {r["page_id"]: r["text"] for r in got} == want
        assert all(r["n_chars"] == len(r["text"]) for r in got) and {(r["page_id"], r["url"]) for r in got} == {r[:2] for r in rows}
    assert pagetext.extracted(df.limit(0)).isEmpty()


def test_cells_stay_bounded_and_whole():
    import pyarrow as pa

    p = pagetext.Extract(cell=100)
    rows = [("h", 0, ["x" * 30]) for _ in range(23)] + [("h", 1, ["y" * 10])] + [("i", 0, ["z" * 500])] * 3 + [("j", 0, [])]
    batches = [pa.RecordBatch.from_pydict({"host": [r[0] for r in part], "salt": [r[1] for r in part], "blocks": pa.array([r[2] for r in part], pa.list_(pa.string()))}) for part in (rows[:9], rows[9:10], rows[10:])]
    cells = [[x for b in cell for x in zip(b["host"].to_pylist(), b["salt"].to_pylist(), b["blocks"].to_pylist(), strict=True)] for cell in pagetext._cells(iter(batches), p)]
    assert [x for c in cells for x in c] == rows and all(len({x[:2] for x in c}) == 1 for c in cells)
    assert max(len(c) for c in cells if c[0][0] == "h") <= 6
