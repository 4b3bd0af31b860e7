import itertools
import random

import numpy as np
import pytest

from roadstream.llm import crf as C
from roadstream.llm import queries as Q
from roadstream.llm.common import table
from pyspark.sql import functions as F


def test_words_and_offsets():
    w = C.Words(["Der Hund, 3x3 läuft!", None, "", "42 -", "ÀB"])
    assert w.count == 5 and w.text.tolist() == [0, 0, 0, 0, 4]
    assert w.places.tolist() == [0, 4, 11, 14, 0]
    assert C.Words(["ab AB ab"]).names().tolist()[0] == C.Words(["Ab"]).names().tolist()[0]
    assert len(set(C.Words(["ab ba abc"]).names().tolist())) == 3


def test_grams_stay_within_a_word():
    w = C.Words(["ab c"])
    counts = [np.bincount(o, minlength=2).tolist() for _, o in w.grams()]
    # ab: a b | ^a ab b$ | ^ab ab$ | ^ab$; c: c | ^c c$ | ^c$
    assert counts == [[2, 1], [3, 2], [2, 1], [1, 0]]


@pytest.mark.parametrize("seed", range(5))
def test_forward_backward_equals_enumeration(seed):
    rng = np.random.default_rng(seed)
    k, chain = 3, np.array([0, 0, 0, 1, 2, 2])
    scores, moves, start = rng.normal(size=(6, k)) * 3, rng.normal(size=(k, k)), rng.normal(size=k)
    want, pairs, begun, log_z = np.zeros((6, k)), np.zeros((k, k)), np.zeros(k), 0.0
    for c in range(3):
        at = np.flatnonzero(chain == c)
        paths = list(itertools.product(range(k), repeat=len(at)))
        total = [start[p[0]] + sum(scores[i, y] for i, y in zip(at, p)) + sum(moves[a, b] for a, b in zip(p, p[1:])) for p in paths]
        z = np.exp(total).sum()
        log_z += np.log(z)
        for p, t in zip(paths, total):
            share = np.exp(t) / z
            begun[p[0]] += share
            for i, y in zip(at, p):
                want[i, y] += share
            for a, b in zip(p, p[1:]):
                pairs[a, b] += share
    got = C.forward_backward(scores, chain, moves, start, expected=True)
    for a, b in zip(got, (want, pairs, begun, log_z), strict=True):
        assert np.allclose(a, b)
    assert np.allclose(C.marginals(scores, chain, moves, start), want)


@pytest.mark.parametrize("seed", range(4))
def test_blocks_give_the_same_marginals(seed):
    rng = np.random.default_rng(seed)
    chain = np.repeat(np.arange(9), rng.choice([1, 2, 127, 128, 129, 700], 9))
    scores = rng.normal(size=(len(chain), 4)) * 8
    moves, start = rng.normal(size=(4, 4)) * 3, rng.normal(size=4)
    want = C.forward_backward(scores, chain, moves, start)[0]
    assert np.allclose(C.marginals(scores, chain, moves, start), want, atol=1e-9)


def code_switched():
    rng = random.Random(1)
    langs = {"aa": ["ka", "ti", "mo", "rak"], "bb": ["sch", "ung", "ein", "zug"]}
    word = lambda x: "".join(rng.choice(langs[x]) for _ in range(rng.randrange(1, 4)))
    train = [(i, " ".join(word(x) for _ in range(30)), x) for i in range(60) for x in (["aa", "bb"][i % 2],)]
    mixed = " ".join(word("aa") for _ in range(25)) + ". " + " ".join(word("bb") for _ in range(12))
    return train, mixed


def test_labels_words_of_mixed_text(spark):
    train, mixed = code_switched()
    labelled = spark.createDataFrame(train + [(99, None, "aa"), (98, "x", None)], "doc_id long, text string, lang string")
    rows = [(1, mixed), (2, None), (3, "12 ?!"), (4, ""), (1, mixed), (None, "schung"), (5, mixed * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    docs = docs.withColumn("lang", F.lit("bb")).withColumn("score", F.lit("x"))
    got = {}
    for r in C.label_words(docs, labelled).collect():
        got.setdefault(r["id"], []).append(r)
    assert [len(v) for _, v in sorted(got.items(), key=lambda x: x[0] or 0)] == [1, 2, 1, 1, 1, 1]
    r = got[1][0]
    assert r["lang_pred"] == "aa" and 0.5 < r["score"] <= 1
    assert [(x["lang"], x["words"]) for x in r["runs"]] == [("aa", 25), ("bb", 12)]
    assert r["runs"][0]["end"] == r["runs"][1]["start"] == mixed.index(". ") + 2
    assert r["runs"][1]["end"] == len(mixed)
    for i in (2, 3, 4):
        assert tuple(got[i][0])[1:] == ("und", 0.0, [])
    assert got[None][0]["lang_pred"] == "bb"
    assert got[5][0]["lang_pred"] == "aa"


def test_nothing_to_learn_from_or_to_label(spark):
    train, _ = code_switched()
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in C.label_words(docs, docs.limit(0)).collect()} == {"und"}
    assert C.label_words(docs.limit(0), docs).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = Q.op6_language(spark, folder).where("held_out")
    truth = table(spark, folder, "documents").select("doc_id", "lang")
    right = got.join(truth, "doc_id").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.97
