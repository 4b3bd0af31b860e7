import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from roadstream.llm import sharding as S
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def placed(spark):
    rng = random.Random(1)
    rows = [(i, f"nr {rng.randrange(1500)} " + "wörd " * 30) for i in range(3000)]
    rows += [(5000 + i, "the same text") for i in range(1500)]
    rows += [(9000, None), (9001, ""), (3, rows[3][1]), (None, "x"), (9002, "long " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumn("size", F.lit("x")).withColumn("rows", F.lit(1)).withColumn("shard", F.lit(0))
    return rows, S.shards(docs, 10).collect()


def test_every_row_has_one_place(placed):
    rows, got = placed
    measure = lambda t: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r["id"], r["size"], r["text_crc32"]) for r in got), key=key) == sorted(
        ((i, *measure(t)) for i, t in rows), key=key
    )
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(10))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_all_three_weights_are_near_equal(placed):
    _, got = placed
    for weight in (lambda r: r["size"], lambda r: r["tokens"], lambda r: 1):
        sums = np.zeros(10)
        for r in got:
            sums[r["shard"]] += weight(r)
        assert sums.max() < 1.03 * sums.mean() and sums.min() > 0.97 * sums.mean()


def test_small_groups_stay_together(placed):
    rows, got = placed
    where = defaultdict(set)
    texts = dict(rows)
    for r in got:
        where[texts[r["id"]] or ""].add(r["shard"])
    assert all(len(s) == 1 for t, s in where.items() if t != "the same text")
    assert len(where["the same text"]) == 10


def test_placement_follows_the_rule():
    rng = np.random.default_rng(3)
    w = rng.integers(1, 50, (60, 3)).astype(float)
    bins = S.place(w, 4)
    share, left = w / w.sum(axis=0), [[0.25] * 3 for _ in range(4)]
    for i in sorted(range(60), key=lambda i: -share[i].max()):
        dots = [sum(a * b for a, b in zip(l, share[i], strict=True)) for l in left]
        assert dots[bins[i]] == pytest.approx(max(dots), abs=1e-12)
        left[bins[i]] = [a - b for a, b in zip(left[bins[i]], share[i], strict=True)]


def test_empty_table(spark):
    assert S.shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0
