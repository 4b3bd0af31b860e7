import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roadstream.llm import packing as P
from roadstream.llm.tokens import encoder
from pyspark.sql import functions as F

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_ids_are_those_of_the_tokenizer(text):
    assert encoder(PATH)(text).tolist() == PLAIN.encode(text, add_special_tokens=False).ids


def test_ids_of_special_texts():
    for text in ("a <|endoftext|> b", "x" * 5000, " \n \t  　 é́ ſ", "don't  I'LL 12345 ½"):
        assert encoder(PATH)(text).tolist() == PLAIN.encode(text, add_special_tokens=False).ids
    words = public_tokenizers.path("word_bpe_49k.json")
    assert encoder(words)("Some Words").tolist() == Tokenizer.from_file(words).encode("Some Words", add_special_tokens=False).ids


def test_pieces_tile_documents_and_sequences(spark):
    rng = random.Random(4)
    vocabulary = ["river", "stone", "Über", "x9", "walks", "\n"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 40, 90])))) for i in range(400)]
    rows += [(900, None), (901, ""), (902, "many words " * 6000), (5, rows[5][1]), (None, "no id")]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumn("length", F.lit(1)).withColumn("ids", F.lit("x"))
    got = P.pack(docs, PATH, window=64, with_ids=True).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[r["id"]].append((r["start"], bytes(r["ids"]), r["doc_tokens"]))
    assert sorted(sequences) == list(range(len(sequences)))
    total = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
        total += at
    assert total > 0.97 * 64 * len(sequences)
    copies = {i: 2 if i == 5 else 1 for i in documents}
    texts = dict(rows)
    for i, pieces in documents.items():
        want = np.array(PLAIN.encode(texts[i] or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        pieces = sorted(pieces)[:: copies[i]]
        assert b"".join(p for _, p, _ in pieces) == want
        assert {n for _, _, n in pieces} == {len(want) // 4}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.pack(docs, PATH).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_plan_uses_all_counts_with_little_padding(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(1025, np.int64)
    if seed < 6:
        smooth = 1.5 - np.arange(1024) / 1024
        counts[1:] = rng.poisson([1, 3, 50, 400, 5000, 60][seed] * smooth)
        counts[rng.integers(1, 1025)] += 40_000 if seed == 5 else 0
    else:
        counts[[700, 324, 5][: seed - 4]] = 10_000
    patterns = P.plan(counts, 1024)
    used = np.zeros_like(counts)
    for way, n in patterns:
        assert n > 0 and sum(way) <= 1024
        for v in way:
            used[v] += n
    assert (used == counts).all()
    windows, ids = sum(n for _, n in patterns), int((counts * np.arange(1025)).sum())
    if seed in (2, 3, 4):
        assert windows * 1024 < 1.01 * ids + 2048


def test_least_squares_meets_a_solvable_histogram():
    counts = np.zeros(101, np.int64)
    counts[[30, 70, 20, 50]] = [90, 50, 40, 60]
    ways = P.fillings(counts, 100)
    x = P.repeats(ways, counts)
    left = counts.astype(float)
    for w, n in zip(ways, x, strict=True):
        for v in w[w > 0]:
            left[v] -= n
    assert np.abs(left).max() < 1 and (x >= 0).all()
