import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from pyspark.sql import functions as F

WORDS = [a + b for a in "ba be bi bo bu da de di do du".split() for b in "k l m n r s t lan ner tis mor".split()]
SECRET = "token=k3J9xQ2mZ7vB1nR5tY8w"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(6)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n)) + "."
    items = [(i, prose(30)) for i in range(6)]
    good = [(i, prose(rng.randrange(60, 120))) for i in range(150)]
    rows = [(i, t, "en", f"s{i % 5}") for i, t in good]
    rows += [(200 + i, "".join(rng.choice("#%&$*QZ!") for _ in range(300)), "en", "s") for i in range(4)]
    rows += [(300, good[3][1], "en", "s"), (301, good[4][1].replace(" ", "\n", 1), "en", "s"), (3, *rows[3][1:])]
    rows += [(400, f"{prose(30)} {items[2][1]} {prose(20)}", "en", "s")]
    rows += [(500, f"{prose(400)} {SECRET} {prose(400)}", "en", "s")]
    rows += [(600, None, "en", None), (601, "", None, "s"), (None, good[9][1], "en", "s"), (None, prose(70), "en", "s")]
    folder = str(tmp_path_factory.mktemp("sf"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long")).withColumn("id", F.lit("x"))
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, folder


def test_each_stage_decides(spark, corpus):
    rows, folder = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, []
    for _, stage in C.STAGES[:-1]:
        docs = C.written(stage(spark, docs, folder))
        assert docs.columns == columns
        ids.append(sorted((r[0] for r in docs.select("doc_id").collect()), key=lambda x: (x is None, x or 0)))
    clean = list(range(150))
    assert ids[0] == sorted([*clean, 3, 300, 301, 400, 500]) + [None, None]
    assert ids[1] == [*clean, 400, 500, None]
    assert ids[2] == ids[3] == [*clean, 500, None]
    text = docs.where("doc_id = 500").first()
    assert SECRET not in text["text"] and "[SECRET]" in text["text"] and text["n_chars"] == len(text["text"])


@pytest.mark.parametrize("stage, gone", [(C.near_dedup_stage, {300, 301}), (C.decontamination_stage, {400})])
def test_rows_go_by_a_number_that_new_splits_leave(spark, corpus, monkeypatch, stage, gone):
    """Between the operator and the removal of its rows the files are split otherwise."""
    rows, folder = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id is not null")
    size, without = "spark.sql.files.maxPartitionBytes", C._without
    before = spark.conf.get(size)

    def split_anew(*args):
        spark.conf.set(size, "2000")
        return C.written(without(*args))

    monkeypatch.setattr(C, "_without", split_anew)
    try:
        kept = {r[0] for r in stage(spark, docs, folder).select("doc_id").collect()}
    finally:
        spark.conf.set(size, before)
    assert {r[0] for r in rows if r[0] is not None} - kept - {600, 601} == gone


def test_run_packs_what_is_kept(spark, corpus):
    rows, folder = corpus
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r[0]: r[1] for r in rows}
    got = C.run(spark, folder).collect()
    lengths = {}
    for r in got:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert set(lengths) == {*range(150), 500, None}
    for i in range(150):
        assert lengths[i] == len(tokens.encode(texts[i], add_special_tokens=False).ids) + 1


def test_empty_table(spark, corpus, tmp_path):
    _, folder = corpus
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        none.write.mode("overwrite").parquet(str(tmp_path / "none"))
        assert stage(spark, spark.read.parquet(str(tmp_path / "none")), folder).count() == 0


def _folders(spark):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(C.own_folder(spark)).getParent()
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in files.listStatus(at) if f.getPath().getName().startswith("roadstream-")}


def test_only_the_result_is_left(spark, corpus):
    _, folder = corpus
    before = _folders(spark)
    result = C.run(spark, folder)
    left = _folders(spark) - before
    assert len(left) == 1 and result.count() > 0 and left.pop() in result.inputFiles()[0]


def test_a_stage_leaves_the_rows_it_decided_on(spark, corpus):
    """No texts: a small table of file names and places, which the lazy result still needs."""
    _, folder = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        before = _folders(spark)
        stage(spark, docs, folder)
        assert len(_folders(spark) - before) == 1


def test_rows_that_come_from_no_file(spark, corpus):
    """They are written with a number first."""
    _, folder = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    made = docs.distinct().withColumn("_file", C.F.lit(1)).withColumn("__place", C.F.lit(2))
    kept = C.near_dedup_stage(spark, made, folder)
    assert kept.columns == made.columns
    assert {300, 301}.isdisjoint(r[0] for r in kept.select("doc_id").collect())
    assert {r[0] for r in C.decontamination_stage(spark, made, folder).select("doc_id").collect()}.isdisjoint({400})
