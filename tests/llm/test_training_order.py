import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roadstream.llm import training_order as T
from pyspark.sql import functions as F

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64, 1000, 4097])
def test_permutation_is_a_bijection_and_has_an_inverse(size):
    for key in (1, 2, 2**70 + 5, -3):
        p = T.Permutation(size, key)
        slots = p.slot(np.arange(size))
        assert sorted(slots.tolist()) == list(range(size))
        assert (p.index(slots) == np.arange(size)).all()


def test_keys_give_other_orders_without_pattern():
    a, b = (T.Permutation(10_000, k).slot(np.arange(10_000)) for k in (1, 2))
    assert (a == b).mean() < 0.01
    assert abs(np.corrcoef(a, np.arange(10_000))[0, 1]) < 0.05
    assert len(np.unique(np.diff(a))) > 5000


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["river", "Über", "x9"], k=rng.choice([1, 30, 200])))) for i in range(120)]
    rows += [(500, None), (501, ""), (7, rows[7][1]), (None, "no id"), (502, "many words " * 4000)]
    source = str(tmp_path_factory.mktemp("docs"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("x"))
    docs.repartition(3).write.mode("overwrite").parquet(source)
    folder = f"file://{tmp_path_factory.mktemp('shards')}"
    run = lambda **kw: T.training_order(spark.read.parquet(source), PATH, folder=folder, length=16, shard_rows=100, **kw)
    return rows, run, folder


def test_sequences_are_whole_and_in_their_slots(made):
    rows, run, _ = made
    got = run().collect()
    assert sorted(r["slot"] for r in got) == list(range(len(got)))
    assert all(r["shard"] == r["slot"] // 100 and r["position"] == r["slot"] % 100 * 36 for r in got)
    documents = defaultdict(list)
    for r in got:
        documents[r["id"]].append((r["start"], r["length"], r["ids_crc32"]))
    for i, text in dict(rows).items():
        ids = np.array(PLAIN.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want = [(s, len(ids[s : s + 16]), zlib.crc32(ids[s : s + 16].tobytes())) for s in range(0, len(ids), 16)]
        assert sorted(documents[i]) == sorted(want * (2 if i == 7 else 1))


def test_order_depends_on_the_key_alone(made):
    _, run, _ = made
    orders = [sorted((r["slot"], r["id"], r["start"]) for r in run(key=k).where("id is not null").collect()) for k in (1, 1, 2)]
    assert orders[0] == orders[1] != orders[2]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.training_order(docs, PATH, folder=f"file://{tmp_path}").count() == 0


def test_what_is_read_back_is_never_broadcast(made):
    _, run, _ = made
    joined = run()
    n = joined.count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert joined.select("slot").distinct().count() == n > 0
