import numpy as np
import pytest

from roadstream.llm import polytope as X
from pyspark.sql import functions as F


def brute_force(rows, every, k):
    seen = {i: np.array(v, float) for i, v in rows}
    out = {}
    for q in seen:
        if q % every == 0:
            best = sorted((-float((seen[q] * v).sum()), i) for i, v in seen.items() if i != q)
            out[q] = [(i, -s) for s, i in best[:k]]
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 64)).astype(np.float32)
    x *= rng.uniform(0.3, 2.0, (3000, 1)).astype(np.float32)  # lengths differ: no cosines
    x[1000:1400] = x[7]
    return [(i, v.tolist()) for i, v in enumerate(x)]


def test_recall_and_scores(spark, cloud):
    odd = [(None, cloud[0][1]), (5000, None), (5020, [0.0] * 64), (5040, [float("nan")] + [1.0] * 63),
           (5060, [None] + [1.0] * 63), (5080, []), (5100, [1.0, 2.0]), (5120, [float("inf")] * 64), cloud[40]]
    frame = table(spark, cloud + odd).repartition(3).withColumn("id", F.lit("x")).withColumn("score", F.lit(1))
    got = X.neighbours(frame).collect()
    want = brute_force(cloud, 20, 20)
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert found.keys() == want.keys()
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in cloud}
    hits = 0
    for q, near in found.items():
        assert len(near) == 20 and len({i for i, _ in near}) == 20
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(s == pytest.approx(float(vectors[q] @ vectors[i]), abs=1e-9) for i, s in near)
        hits += len({i for i, _ in near} & {i for i, _ in want[q]})
    assert hits >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("block", [4096, 100])
def test_ties_go_to_the_smaller_id(spark, cloud, monkeypatch, block):
    monkeypatch.setattr(X, "BLOCK", block)
    got = X.neighbours(table(spark, cloud)).where("query_id between 1000 and 1399").collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    for q, near in by.items():
        copies = [i for i in [7, *range(1000, 1400)] if i != q][:20]
        assert near == copies


def recall(spark, x):
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    got = X.neighbours(table(spark, rows).repartition(3), every=50).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    y = np.array([v for _, v in rows])
    hits = []
    for q in range(0, len(y), 50):
        score = y @ y[q]
        score[q] = -np.inf
        hits.append(len(found[q] & set(np.argsort(-score, kind="stable")[:20].tolist())) / 20)
    return np.mean(hits)


@pytest.mark.parametrize("times", [3, 10, 100])
def test_one_long_vector_leaves_the_recall(spark, times):
    x = np.random.default_rng(3).standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[1234] *= times
    assert recall(spark, x) >= 0.95


def test_recall_on_the_given_table(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    x = np.array([r["embedding"] for r in given.orderBy("vec_id").collect()])
    assert recall(spark, x) >= 0.95


def test_few_vectors_give_all_candidates(spark):
    rows = [(i, [float(i % 3 - 1), 1.0, float(i)]) for i in range(1, 13)] + [(20, [-1.0, -1.0, -1.0])]
    got = {}
    for r in X.neighbours(table(spark, rows)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    want = brute_force(rows, 20, 20)
    assert {q: [i for _, i in sorted(n)] for q, n in got.items()} == {q: [i for i, _ in n] for q, n in want.items()}


def test_empty_and_lonely(spark):
    assert X.neighbours(table(spark, [])).count() == 0
    assert X.neighbours(table(spark, [(20, [1.0, 2.0])])).count() == 0


def test_pseudo_rotation_keeps_products():
    x = np.random.default_rng(2).standard_normal((5, 128))
    s = X.axes(x, 3)[:, :128]
    assert np.allclose(s @ s.T, x @ x.T)
    up, q = X.lifted(x[:, :64], 20.0, False), X.lifted(x[:, :64], 20.0, True)
    assert np.allclose(np.linalg.norm(up, axis=1), 1) and np.allclose(np.linalg.norm(q, axis=1), 1)
