import math
import random
from collections import Counter

import numpy as np
import pytest

from roadstream.llm import quality as Q
from pyspark.sql import functions as F

WORDS = "the of and river stone walks over bridge slowly near old town green light".split()


def prose(rng, n=60):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng), "en" if i % 3 else "xx") for i in range(80)]
    junk = [(100 + i, "".join(rng.choice("#%&$*QZ!") for _ in range(200)), "en") for i in range(5)]
    odd = [(200, None, "en"), (201, "", "en"), (202, rows[3][1], None), (203, rows[3][1], "new"),
           (3, rows[3][1], "xx"), (None, rows[4][1], "en"), (204, junk[0][1] * 400, "en")]
    docs = spark.createDataFrame(rows + junk + odd, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(80)] + [(1,), (None,)], "doc_id long")
    return docs, trusted


def brute_force(texts, alphabet):
    """Interpolated modified Kneser-Ney by dictionaries: symbols before -> probabilities."""
    symbol = Q._symbols(alphabet)
    seqs = [[0] * (Q.ORDER - 1) + [int(symbol[ord(c)]) for c in t] for t in texts]
    counts = {Q.ORDER: Counter(tuple(s[i : i + Q.ORDER]) for s in seqs for i in range(len(s) - Q.ORDER + 1))}
    for k in range(Q.ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    rates = {}
    for k, c in counts.items():
        n = Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
        rates[k] = []
        for j in (1, 2, 3):
            d = j - (j + 1) * y * n[j + 1] / n[j] if y is not None and n[j] else None
            rates[k].append(d if d is not None and 0 < d < j else 0.5)
    follow = {k: {} for k in counts}
    for k, c in counts.items():
        for g, n in c.items():
            follow[k].setdefault(g[:-1], {})[g[-1]] = n

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / 63
        after = follow[k].get(gram[:-1])
        if not after:
            return p(gram[1:])
        off = lambda n: rates[k][min(n, 3) - 1]
        total = sum(after.values())
        n = after.get(gram[-1], 0)
        back = sum(off(x) for x in after.values()) / total
        return (n - off(n) if n else 0) / total + back * p(gram[1:])

    def perplexity(text):
        s = [0] * (Q.ORDER - 1) + [int(symbol[ord(c)]) for c in text]
        logs = [math.log(p(tuple(s[i : i + Q.ORDER]))) for i in range(len(s) - Q.ORDER + 1)]
        return math.exp(-sum(logs) / len(logs))

    return perplexity


@pytest.mark.parametrize("most", [10**9, 0])
def test_perplexity_equals_brute_force(spark, corpus, most):
    docs, trusted = corpus
    got = {}
    for r in Q.quality(docs, trusted, broadcast_rows=most).collect():
        got.setdefault((r["id"], r["lang"]), r)
    rows = docs.collect()
    good = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 80]
    alphabet = Q._alphabet(spark.createDataFrame([(r["text"],) for r in good], "text string"))
    models = {None: brute_force([r["text"] for r in good], alphabet)}
    for lang in ("en", "xx"):
        models[lang] = brute_force([r["text"] for r in good if r["lang"] == lang], alphabet)
    for r in rows:
        out = got[(r["doc_id"], r["lang"])]
        if not r["text"]:
            assert out["perplexity"] is None and not out["kept"]
            continue
        want = models[r["lang"] if r["lang"] in models else None](r["text"][:20000])
        assert out["perplexity"] == pytest.approx(want, rel=2e-3)
        assert out["kept"] == (r["doc_id"] is None or r["doc_id"] < 100 or r["doc_id"] in (202, 203))


@pytest.fixture(scope="module")
def many_letters(spark):
    """Texts of two hundred letters beyond those with symbols of their own, in a fixed order."""
    rng = random.Random(8)
    letters = [chr(0x4E00 + i) for i in range(200)]
    order = {x: rng.sample(letters, 2) for x in letters}

    def sentence(n=80):
        text = [rng.choice(letters)]
        while len(text) < n:
            text.append(rng.choice(order[text[-1]]))
        return "".join(text)

    common = "".join(chr(c) for c in range(0x3B1, 0x3B1 + Q.LETTERS)) * 300
    good = [(i, sentence() if i else common.lower(), "zz") for i in range(200)]
    mixed = [(300 + i, "".join(rng.choice(letters) for _ in range(80)), "zz") for i in range(5)]
    docs = spark.createDataFrame([*good, *mixed, (400, "\u0e01" * 80, "zz"), (401, "", "zz")], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(i,) for i in range(200)], "doc_id long")


@pytest.mark.parametrize("most", [10**9, 0])
def test_letters_beyond_the_symbols_are_told_apart(many_letters, most):
    docs, trusted = many_letters
    got = {r["id"]: r for r in Q.quality(docs, trusted, broadcast_rows=most).collect()}
    assert len(got) == docs.count()
    assert not any(got[300 + i]["kept"] for i in range(5))
    assert sum(got[i]["kept"] for i in range(200)) >= 196
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    alphabet = Q._alphabet(docs.where("doc_id < 200"))
    symbol, spelled = Q._symbols(alphabet), Q._spelled(alphabet)

    def spelling(text):
        """One character a symbol, so that the plain model reads it as it is."""
        out = []
        for c in text:
            number, first = divmod(int(symbol[ord(c)]), 64)
            rest = [1 + number // 63**k % 63 for k in reversed(range(spelled))] if first == Q.RARE else []
            out += [first, *rest]
        return "".join(map(chr, out))

    class Plain(dict):
        def __getitem__(self, c):
            return c

    keep, Q._symbols = Q._symbols, lambda alphabet: Plain()
    try:
        plain = brute_force([spelling(texts[i]) for i in range(200)], alphabet)
    finally:
        Q._symbols = keep
    assert spelled == 2 and len(alphabet) > Q.LETTERS + Q.SPELLING
    for i in (0, 1, 50, 300, 400):
        word = spelling(texts[i])
        want = math.exp(math.log(plain(word)) * len(word) / len(texts[i]))
        assert got[i]["perplexity"] == pytest.approx(want, rel=2e-3)
    assert got[401]["perplexity"] is None and not got[401]["kept"]


def test_spelling_tells_every_letter_apart():
    for n, width in ((Q.LETTERS, 0), (Q.LETTERS + 1, 1), (Q.LETTERS + 62, 1), (Q.LETTERS + 63, 2), (10_000, 3)):
        alphabet = list(range(0x4E00, 0x4E00 + n))
        symbol, spelled = Q._symbols(alphabet), Q._spelled(alphabet)
        assert spelled == width
        texts = [chr(c) for c in [*alphabet, 0x3B1]] + ["", None]
        code, lengths = Q._grams(texts, symbol, spelled)
        ends = np.cumsum(lengths)
        words = {tuple(code[e - k : e] & 63) for e, k in zip(ends, lengths) if k}
        assert len(words) == n + 1 and not any(Q.EDGE in w for w in words)
        assert lengths[-2:].tolist() == [0, 0] and lengths[-3] == 1 + width


def test_rows_stay_whole(spark, corpus):
    docs, trusted = corpus
    more = docs.withColumn("id", F.lit("x")).withColumn("perplexity", F.lit(1)).withColumn("trusted", F.lit(2))
    back = Q.quality(more, trusted, keep_rows=True)
    assert back.select("row.*").columns == more.columns
    assert back.count() == docs.count()


def test_empty_tables(spark, corpus):
    docs, trusted = corpus
    assert Q.quality(docs.limit(0), trusted).count() == 0
    kept = Q.quality(docs, trusted.limit(0)).collect()
    assert len(kept) == docs.count()
    assert {r["id"] for r in kept if not r["kept"]} == {200, 201}


def test_folds_case_digits_and_space():
    fold = Q._fold()
    assert [chr(fold[ord(c)]) for c in "Äq7\t٣Z"] == ["A", "q", "0", " ", "0", "A"]


def test_text_with_nul_characters_is_no_edge():
    symbol = Q._symbols([ord(c) for c in "abc"])
    code, lengths = Q._grams(["a\0\0\0b", None, "", "c"], symbol)
    assert lengths.tolist() == [5, 0, 0, 1] and len(code) == 6
    assert code[-1] == Q._grams(["c"], symbol)[0][0]
    assert np.all(code[1:5] & 63 != 0)


def in_order(rng, letters, order, n):
    text = [rng.choice(letters)]
    while len(text) < n:
        text.append(rng.choice(order[text[-1]]))
    return "".join(text)


@pytest.mark.parametrize("most", [10**9, 0])
@pytest.mark.parametrize("letters", ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\u00a0\u2003\u3000"])
def test_capitals_digits_and_white_space_are_told_apart(spark, letters, most):
    rng = random.Random(9)
    order = {x: [letters[(i + 1) % len(letters)], letters[(i + 2) % len(letters)]] for i, x in enumerate(letters)}
    good = [(i, in_order(rng, letters, order, 120), "en") for i in range(60)]
    mixed = [(100 + i, "".join(rng.choice(letters) for _ in range(120)), "en") for i in range(5)]
    docs = spark.createDataFrame(good + mixed, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(60)], "doc_id long")
    got = {r["id"]: r for r in Q.quality(docs, trusted, broadcast_rows=most).collect()}
    assert sum(got[i]["kept"] for i in range(60)) >= 59
    assert not any(got[100 + i]["kept"] for i in range(5))


def test_every_character_of_the_trusted_texts_has_its_own_symbol(spark):
    text = "Äq7\t\u0663Z A0 \n" + "".join(chr(c) for c in range(0x391, 0x3CA) if c != 0x3A2)
    alphabet = Q._alphabet(spark.createDataFrame([(text,)], "text string"))
    symbol = Q._symbols(alphabet)
    assert sorted(alphabet) == sorted({ord(c) for c in text}) and len(alphabet) > Q.LETTERS
    assert len({int(symbol[c]) for c in alphabet}) == len(alphabet)
    unseen = {int(symbol[ord(c)]) for c in "Bq1\u2003\u4e00"} - {int(symbol[ord("q")])}
    assert unseen == {Q.UPPER, Q.DIGIT, Q.SPACE, Q.RARE} and not unseen & {int(symbol[c]) for c in alphabet}
