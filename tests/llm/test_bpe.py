import hashlib
import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roadstream.llm import bpe
from roadstream.llm import queries as Q
from pyspark.sql import functions as F

PATH = public_tokenizers.path("word_bpe_49k.json")
BITS = ["a", "b", "aa", "th", "ing", "'s", "'re", "'", "É", "é", "Σ", "ς", "ΑΣ", "İ", "1", "23", "½", "😀", "日本", " ", "\n", "\x85",
        "\x1c", " ", " ", "<|startoftext|>", "<|endoftext|>", "<|", "!!!", "...", "_", "́", "ﬁ", "ß", "ẞ", "​", "한", "가",
        "﻿", "͸", "aaaa", "abab"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.vocabulary(PATH))


def random_text(rng):
    return "".join(rng.choice(BITS) for _ in range(rng.randrange(50)))


def test_ids_equal_the_library(library, encoder):
    rng = random.Random(3)
    texts = [random_text(rng) for _ in range(8000)] + ["", None, "a" * 5000, "ab" * 3000, "the " * 5000]
    got = bpe._block_ids(texts, encoder).to_pylist()
    for text, ids in zip(texts, got, strict=True):
        assert ids == library.encode(text or "", add_special_tokens=False).ids


def test_every_character(library, encoder):
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(f"x{chr(c)}y {chr(c)} " for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    for text, ids in zip(texts, bpe._block_ids(texts, encoder).to_pylist(), strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_blocks_do_not_matter(encoder, monkeypatch):
    """What was learnt before, and forgetting it, changes nothing."""
    rng = random.Random(8)
    texts = [random_text(rng) for _ in range(300)]
    want = bpe._block_ids(texts, encoder).to_pylist()
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    own = bpe.Encoder(bpe.vocabulary(PATH))
    assert [bpe._block_ids([t], own).to_pylist()[0] for t in texts] == want


def test_the_index_merges_as_words_do_alone():
    vocab = bpe.vocabulary(PATH)
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeéth") for _ in range(rng.randrange(1, 30))).encode() for _ in range(2000)]
    assert bpe.merged(words, vocab) == [bpe.merged([w], vocab)[0] for w in words]


def test_query_equals_the_library(spark, library, tmp_path):
    rng = random.Random(4)
    rows = [(i, random_text(rng), 1) for i in range(200)] + [(200, None, 1), (201, "", 1), (None, "null id", 1), (3, "again", 1), (3, "again", 1)]
    rows.append((300, "long words " * 400_000, 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").selectExpr("*", "1 id", "2 decoded")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = Q.op13_bpe(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_decoding_of_odd_ids(spark):
    rows = spark.createDataFrame([(1, [320, None, 99999999, 320]), (2, []), (3, None), (4, [49407])], "k int, ids array<int>")
    got = {r["k"]: r["text"] for r in bpe.decoded(rows, PATH, name="text").collect()}
    assert got == {1: "a</w> a</w>", 2: "", 3: None, 4: "<|endoftext|>"}


def test_other_files_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="word ends"):
        bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    other = tmp_path / "odd.json"
    other.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError, match="earlier merges"):
        bpe.vocabulary(str(other))


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    found = bpe.digests(bpe.decoded(bpe.encoded(none, PATH), PATH))
    assert found.collect() == [] and found.select(F.col("n_tokens")).columns == ["n_tokens"]
