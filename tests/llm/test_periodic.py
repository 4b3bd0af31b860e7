import hashlib
import random
import zlib

import numpy as np
import pytest

from roadstream.llm import periodic as R
from roadstream.llm import queries as Q

WHITE = " \t\n\v\f\r"


def brute(w):
    """All runs straight from the definition, by every period."""
    n, out = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            a = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size, s = i - a + q, w[a : i + q]
            if i > a and size >= max(6, 4 * q) and not any(s[: size - r] == s[r:] for r in range(1, q)):
                out.add((a, size, q))
            i += i == a
    return sorted(out, key=lambda r: (r[0], r[2]))


def plant(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]


def expected(doc_id, text):
    for c in WHITE[1:]:
        text = (text or "").replace(c, " ")
    words = [w for w in (text or "").split(" ") if w]
    words = words if doc_id is None else plant(doc_id, words)
    runs = brute(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *first, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def random_words(rng):
    kinds, out = rng.choice([1, 2, 2, 3, 5, 50]), []
    for _ in range(rng.randrange(1, 6)):
        base = [rng.randrange(1, kinds + 1) for _ in range(rng.randrange(1, 30))]
        out += (base * rng.choice([1, 1, 2, 4, 5, 7]))[: rng.randrange(1, 200)]
    return out


def test_runs_equal_brute_force():
    rng = random.Random(5)
    total = 0
    for _ in range(1500):
        words = random_words(rng)
        found = R.find_runs(np.array(words))
        assert found == brute(words)
        total += len(found)
    assert total > 2000


def test_transform_and_back():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        x = rng.integers(0, R.PRIME, (3, size)).astype(np.uint64)
        assert (R.untransform(R.transform(x.copy())) == x).all()


def test_occurrences_are_those_without_mismatch():
    rng = np.random.default_rng(2)
    ids = rng.integers(1, 3, 400)
    ids[100:160] = np.tile(ids[100:107], 9)[:60]
    starts = np.arange(0, 390, 8)
    got = set(zip(*map(np.ndarray.tolist, R.occurrences(ids, starts, 8, 5, 10)), strict=True))
    want = {(s, d) for s in starts.tolist() for d in range(5, 11) if s + d + 8 <= 400 and (ids[s : s + 8] == ids[s + d : s + d + 8]).all()}
    assert got == want and want


@pytest.mark.parametrize("words", [np.ones(60_000, int), np.tile(np.arange(1, 3001), 20), np.arange(1, 200_001)])
def test_long_texts(words):
    found = R.find_runs(words)
    assert found == ([] if len(words) == 200_000 else [(0, 60_000, 1 if words[0] == words[1] else 3000)])


def test_query_equals_the_definition(spark, tmp_path):
    rng = random.Random(9)
    planted = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = []
    for i in [*range(60), *planted[:60]]:
        words = random_words(rng) if i % 2 else [rng.randrange(500) for _ in range(rng.randrange(200))]
        rows.append((i, "".join(f"w{w}" + rng.choice([" ", "\n", "\t ", " \v"]) for w in words), 1))
    rows += [(planted[0], None, 2), (planted[1], "", 2), (planted[2], " \n", 2), (planted[3], "one", 2), (None, "a a a a a a b", 3)]
    rows += [(5, "x x x x x", 4), (7, "x x " * 6, 4), rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").selectExpr("*", "1 id", "2 collapsed", "3 _n")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = Q.op11_periodic_runs(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected(i, t) for i, t, _ in rows), key=repr)


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r) for r in Q.op11_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for r in docs:
        if len(r["text"] or "") < 6000:
            assert got[r["doc_id"]] == expected(r["doc_id"], r["text"])


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert R.digests(R.periodic_runs(none)).collect() == []
