"""A host's runs are counted over all its pages, whatever the number of its parts."""

import random

import pytest

from variorum.llm import pagetext


@pytest.mark.parametrize("main", [False, True])
def test_parts_of_a_host_make_one_array(spark, main):
    rng = random.Random(7)
    say = lambda n: " ".join("".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(n))
    lines = [say(12) for _ in range(40)]
    need = 130 if main else 26
    have = [set(rng.sample(range(260), need + rng.choice([-2, -1, 0, 1]))) for _ in lines]
    rows = []
    for i in range(260):  # lines that the outer or inner share of distinct pages just has or has not
        held = " ".join(f"<div>{lines[k]}</div><div>{say(9 * (10 if main else 1))}</div>" for k in range(40) if i in have[k])
        rows.append((i, f"http://a.org/{i}", f"<article>{held}<p>{i}</article>" if main else f"{held}<p>{i}"))
    rows += [(1000 + i, f"http://a.org/copy/{i}", rows[i % 5][2]) for i in range(90)]  # copies count once
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    whole = {tuple(r) for r in pagetext.extracted(df).collect()}
    assert len(whole) == len(rows)
    gone = {k for k in range(40) if not any(lines[k] in r[2] for r in whole)}
    assert gone == {k for k in range(40) if len(have[k]) >= need} and 0 < len(gone) < 40
    assert {tuple(r) for r in pagetext.extracted(df, pagetext.Extract(cell=1 << 13)).collect()} == whole
