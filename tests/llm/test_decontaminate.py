import random

import pytest

from roadstream.llm import decontaminate as D
from pyspark.sql import functions as F

COMMON = "the of and to in is was for on that".split()


def prose(rng, n):
    made = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 4)))
    return [rng.choice(COMMON) if rng.random() < 0.4 else made() for _ in range(n)]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(3)
    items = [(i, " ".join(prose(rng, rng.randrange(12, 50)))) for i in range(30)]
    items += [(30, None), (31, ""), (32, items[4][1]), (4, items[4][1])]
    rows, want = [], set()
    for i in range(120):
        rows.append((i, " ".join(prose(rng, rng.randrange(1, 400)))))
    for i in range(30):
        w = items[i][1].split()
        if i % 3 == 1:  # a word in eight replaced
            w = [x if j % 8 else "zzz" for j, x in enumerate(w, 1)]
        if i % 3 == 2:  # words put in between
            w = [y for j, x in enumerate(w) for y in ([x, "then"] if j % 6 == 0 else [x])]
        text = prose(rng, rng.randrange(0, 90)) + w + prose(rng, rng.randrange(0, 90))
        rows.append((1000 + i, " ".join(text).upper() if i % 2 else ",\n".join(text)))
        want.add((1000 + i, i))
    want.add((1004, 32))
    rows += [(2000, None), (2001, ""), (2002, " .\n"), (1000, rows[120][1])]
    rows.append((2003, " ".join(prose(rng, 60000)) + " " + items[7][1]))
    want.add((2003, 7))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return docs, spark.createDataFrame(items, "item_id long, text string"), want


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 1500])
def test_finds_planted_items_and_nothing_else(planted, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    docs, items, want = planted
    docs = docs.withColumn("item_id", F.lit(1)).withColumn("terms", F.lit(2))
    got = [(r["id"], r["item_id"]) for r in D.leaks(docs, items).collect()]
    assert set(got) == want
    assert len(got) == len(want) + 1  # the repeated row of document 1000


def test_answer_decides_between_the_limits(spark):
    rng = random.Random(8)
    item = prose(rng, 30)
    half = [x if j % 3 else "qq" for j, x in enumerate(item)]
    docs = spark.createDataFrame(
        [(1, " ".join(half[:25] + item[25:])), (2, " ".join(half[:29] + ["qq"]))], "doc_id long, text string"
    )
    bench = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    got = D.leaks(docs, bench, cosine=0.2).collect()
    assert [(r["id"], r["answered"]) for r in got] == [(1, True)]


def test_empty_tables(planted):
    docs, items, _ = planted
    assert D.leaks(docs.limit(0), items).count() == 0
    assert D.leaks(docs, items.limit(0)).count() == 0


def test_common_subsequence_equals_the_table():
    import numpy as np

    rng = random.Random(4)
    for _ in range(200):
        a = [rng.randrange(1, 6) for _ in range(rng.randrange(1, 20))]
        b = [rng.randrange(0, 6) for _ in range(rng.randrange(0, 30))]
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        bits = {}
        for i, x in enumerate(a):
            bits[x] = bits.get(x, 0) | 1 << i
        assert D.common_subsequence(bits, len(a), b) == t[-1, -1]


def test_cuts_leave_no_window_out():
    import numpy as np

    halves = np.repeat(np.arange(50), 8)
    parts = list(D._cuts(halves, 70, again=False))
    assert [a for a, _ in parts[1:]] == [b for _, b in parts[:-1]] and all(b % 8 == 0 for _, b in parts)
    for most in (1, 7, 60, 500):
        cuts = list(D._cuts(halves, most))
        pairs = {(int(halves[lo]), int(halves[hi - 1])) for lo, hi in cuts}
        assert cuts[0][0] == 0 and cuts[-1][1] == 400
        assert all(a[1] == b[0] for a, b in zip(sorted(pairs), sorted(pairs)[1:], strict=False))
