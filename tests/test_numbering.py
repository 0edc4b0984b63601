"""Page numbers shared by several sources, against the plain fold over all arrivals."""

import random

import pytest
from pyspark.sql import functions as F

from variorum.operators import numbering


def plain(arrivals):
    """arrivals: (book, rank, unit, kind, page) in reading order."""
    taken, last, seen, out = {}, {}, {}, {}
    runs = {}
    for book, rank, unit, kind, page in arrivals:
        mine, numbers = taken.setdefault(book, set()), None
        highest = seen.get(book, 0)
        before = runs.get(book)
        on = before is not None and before[:2] == (rank, kind) and (kind != "page" or before[2] + 1 == page)
        at_start = before[3] if on else highest
        runs[book] = (rank, kind, page, at_start)
        duplicate = False
        if kind == "page":
            duplicate = page in mine
            if not duplicate:
                numbers = page
                last[book, rank] = max(last.get((book, rank), 0), page)
        elif kind == "orphan":
            numbers = last.get((book, rank), 0) + 2
            while numbers in mine:
                numbers += 1
            last[book, rank] = numbers
        if numbers is not None:
            mine.add(numbers)
            seen[book] = max(highest, numbers)
        out[book, rank, unit] = (numbers, duplicate, at_start)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_shared_numbers(spark, seed):
    rng = random.Random(seed)
    arrivals = []
    for book in (None, "x", "y", "z"):
        for rank in range(rng.randint(1, 5)):
            page = rng.randint(0, 6)
            for unit in range(rng.randint(0, 60)):
                kind = rng.choices(["page", "orphan", "review"], [6, 2, 1])[0]
                page = page + 1 if rng.random() < 0.8 else max(0, page + rng.randint(-5, 6))
                arrivals.append((book, rank * 3 - 4, unit, kind, page if kind == "page" else None))
    want = plain(arrivals)
    rows = arrivals[:]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "book string, source_rank int, unit_no int, kind string, page_number int").withColumn("seg", F.lit(0)).withColumn("n", F.lit("mine"))
    got = numbering.shared_numbers(df, ["book"]).collect()
    assert len(got) == len(arrivals)
    assert {(r["book"], r["source_rank"], r["unit_no"]): (r["number"], r["duplicate"], r["last_page"]) for r in got} == want
    # cut runs change nothing but where the last page is looked up
    small = numbering.shared_numbers(df, ["book"], bucket_width=4).collect()
    assert {(r["book"], r["source_rank"], r["unit_no"]): (r["number"], r["duplicate"]) for r in small} == {k: v[:2] for k, v in want.items()}
    assert numbering.shared_numbers(df.limit(0), ["book"]).isEmpty()


def test_intervals():
    rng = random.Random(4)
    for _ in range(50):
        taken, free = numbering.Intervals(), set(range(100))
        for _ in range(rng.randint(1, 25)):
            lo = rng.randint(0, 90)
            hi = lo + rng.randint(1, 9)
            want = [x for x in range(lo, hi) if x in free]
            assert [x for a, b in taken.take(lo, hi) for x in range(a, b)] == want
            free -= set(want)
            x = rng.randint(0, 99)
            assert taken.next_free(x) == next((y for y in range(x, 200) if y in free or y > 99))
            assert all(h < lo for h, lo in zip(taken.hi, taken.lo[1:]))
