"""Language of each word by a linear-chain conditional random field.

A word's features are its character n-grams of one to four characters with its edges,
which include its affixes, and its entry in a lexicon of common words. Weights of features
and of transitions between the languages of neighbouring words are learned together from
a bounded sample of segments; forward-backward gives every word's distribution.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstream.llm.common import in_arrow
from roadstream.llm.shingles import mix

#: Segments of so many words are drawn from all labelled texts, so many per language.
SEGMENT, SEGMENTS = 40, 2000
BUCKETS = 1 << 17
ORDERS = (1, 2, 3, 4)
#: A word this common in the sample has a lexicon entry.
LEXICON_COUNT = 4
STEPS, RATE, DECAY = 60, 0.25, 1e-4
UNKNOWN = "und"

_TABLES: list[np.ndarray] = []


def _lower_letters() -> np.ndarray:
    """Code point to lower-case letter, 0 for all that is no letter."""
    if not _TABLES:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _TABLES.append(table)
    return _TABLES[0]


class Words:
    """The words (runs of letters) of texts, one after another, with their features."""

    def __init__(self, texts: list[str | None]):
        lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
        joined = "\n" + "".join(f"{t or ''}\n" for t in texts)
        letters = _lower_letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        is_letter = letters > 0
        # One separator between words: a non-letter stays only after a letter or at the start.
        keep = is_letter | np.r_[True, is_letter[:-1]]
        text_of = np.repeat(np.arange(len(texts)), lengths + 1)
        self.codes = letters[keep].astype(np.uint64)
        inside = self.codes > 0
        self.begins = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
        self.word = np.cumsum(inside & ~np.r_[False, inside[:-1]]) - 1
        self.count = len(self.begins)
        self.text = text_of[np.flatnonzero(keep)[self.begins] - 1] if self.count else np.zeros(0, np.int64)
        self.places = np.flatnonzero(keep)[self.begins] - 1 - (np.cumsum(lengths + 1) - lengths - 1)[self.text]

    def names(self) -> np.ndarray:
        """A hash of each word."""
        if not self.count:
            return np.zeros(0, np.uint64)
        at = np.flatnonzero(self.codes)
        place = (at - self.begins[self.word[at]]).astype(np.uint64)
        h = mix(self.codes[at] * np.uint64(0x9E3779B97F4A7C15) + place * np.uint64(0xD6E8FEB86659FD93))
        return np.add.reduceat(h, np.flatnonzero(np.r_[True, np.diff(self.word[at]) > 0]))

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each order the buckets of n-grams and the words they belong to, in order.
        An n-gram may begin or end, but not go on, beyond its word."""
        c = self.codes
        inside = c > 0
        for n in ORDERS:
            k = len(c) - n + 1
            if k <= 0:
                continue
            if n <= 2:
                ok = inside[:k] if n == 1 else inside[:k] | inside[1:]
                owner = np.where(inside[:k], self.word[:k], self.word[n - 1 :])
            else:
                ok = inside[1 : k + 1]
                for i in range(2, n - 1):
                    ok = ok & inside[i : k + i]
                owner = self.word[1 : k + 1]
            at = np.flatnonzero(ok)
            h = np.full(len(at), n, np.uint64)
            for i in range(n):
                h = h * np.uint64(0x100000001B3) + c[at + i]
            yield (mix(h) % np.uint64(BUCKETS)).astype(np.int32), owner[at]


class Model:
    def __init__(self, langs, weights, lexicon, lexicon_weights, moves, start):
        self.langs, self.weights, self.moves, self.start = langs, weights, moves, start
        self.lexicon, self.lexicon_weights = lexicon, lexicon_weights

    def emissions(self, words: Words) -> np.ndarray:
        out = np.zeros((words.count, len(self.langs)), np.float32)
        for bucket, owner in words.grams():
            firsts = np.flatnonzero(np.r_[True, np.diff(owner) > 0])
            out[owner[firsts]] += np.add.reduceat(self.weights[bucket], firsts, axis=0)
        if words.count and len(self.lexicon):
            names = words.names()
            at = np.minimum(np.searchsorted(self.lexicon, names), len(self.lexicon) - 1)
            known = self.lexicon[at] == names
            out[known] += self.lexicon_weights[at[known]]
        return out

    def marginals(self, words: Words) -> np.ndarray:
        return marginals(self.emissions(words), words.text, self.moves, self.start)


def forward_backward(
    scores: np.ndarray, chain: np.ndarray, moves: np.ndarray, start: np.ndarray, expected: bool = False
):
    """Marginals of each position of the chains (runs of equal ``chain``), all chains at
    once: step t works on those that are longer than t. With ``expected`` also the expected
    transition and start counts, and the log of the partition function in all."""
    n, k = scores.shape
    out = np.zeros((n, k))
    pairs, begun, log_z = np.zeros((k, k)), np.zeros(k), 0.0
    if not n:
        return out, pairs, begun, log_z
    first = np.flatnonzero(np.r_[True, np.diff(chain) != 0])
    length = np.diff(np.r_[first, n])
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    active = np.searchsorted(-length, -np.arange(length[0]), "left")  # chains longer than t
    top = scores.max(axis=1, keepdims=True).astype(np.float64)
    local = np.exp(scores - top)
    shift = max(moves.max(), -700.0)
    move = np.exp(moves - shift)
    alpha = np.empty((n, k))
    a = local[first] * np.exp(start - start.max())
    scale = a.sum(axis=1, keepdims=True)
    a /= scale
    alpha[first] = a
    logs = np.log(scale).sum() + top.sum() + start.max() * len(first)
    for t in range(1, len(active)):
        at = first[: active[t]] + t
        a = (a[: active[t]] @ move) * local[at]
        scale = a.sum(axis=1, keepdims=True)
        a /= scale
        alpha[at] = a
        if expected:
            logs += np.log(scale).sum() + shift * len(at)
    b = np.ones((len(first), k))
    for t in range(len(active) - 1, -1, -1):
        at = first[: active[t]] + t
        m = alpha[at] * b[: active[t]]
        m /= m.sum(axis=1, keepdims=True)
        out[at] = m
        if t:
            ahead = b[: active[t]] * local[at]
            back = ahead @ move.T
            if expected:
                both = alpha[at - 1][:, :, None] * move[None] * ahead[:, None, :]
                pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b[: active[t]] = back / back.sum(axis=1, keepdims=True)
    if expected:
        begun = out[first].sum(axis=0)
        log_z = logs
    return out, pairs, begun, log_z


#: Positions of a block of the blocked form.
BLOCK = 128


def marginals(scores: np.ndarray, chain: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The marginals of ``forward_backward`` in steps whose number does not grow with the
    longest chain. A position is a matrix, that of a chain's first position forgets what
    was before, so that all chains are one product; it is cut into blocks that are
    multiplied side by side, and what enters each block is passed along block by block."""
    n, k = scores.shape
    if not n:
        return np.zeros((0, k))
    blocks = -(-n // BLOCK)
    local = np.ones((blocks * BLOCK, k))
    local[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    # What fills the last block is a chain of its own.
    first = np.ones(blocks * BLOCK, bool)
    first[:n] = np.r_[True, np.diff(chain) != 0]
    move = np.exp(moves - moves.max())
    begin = np.broadcast_to(np.exp(start - start.max()), (k, k))
    local, first = local.reshape(blocks, BLOCK, k), first.reshape(blocks, BLOCK)

    def step(t: int) -> np.ndarray:
        return np.where(first[:, t, None, None], begin, move) * local[:, t, None, :]

    whole = step(0)
    for t in range(1, BLOCK):
        whole = whole @ step(t)
        whole /= whole.sum(axis=(1, 2), keepdims=True)
    enter, leave = np.ones((blocks, k)) / k, np.ones((blocks, k)) / k
    for b in range(1, blocks):
        a = enter[b - 1] @ whole[b - 1]
        enter[b] = a / a.sum()
        z = whole[blocks - b] @ leave[blocks - b]
        leave[blocks - b - 1] = z / z.sum()
    alpha, a, z = np.empty((blocks, BLOCK, k)), enter, leave
    for t in range(BLOCK):
        a = np.where(first[:, t, None], begin[0], a @ move) * local[:, t]
        a = a / a.sum(axis=1, keepdims=True)
        alpha[:, t] = a
    for t in range(BLOCK - 1, -1, -1):
        alpha[:, t] *= z
        ahead = z * local[:, t]
        z = np.where(first[:, t, None], (ahead @ begin[0])[:, None], ahead @ move.T)
        z = z / z.sum(axis=1, keepdims=True)
    out = alpha.reshape(-1, k)[:n]
    return out / out.sum(axis=1, keepdims=True)


# --- training --------------------------------------------------------------------------


def sample(labelled: DataFrame) -> list[tuple[str, str]]:
    """(lang, segment): of all segments of the texts of a language those with the smallest
    hashes. A task keeps no more than ``SEGMENTS`` of each, nor does the driver."""

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        import re

        import xxhash

        best: dict[str, dict[int, str]] = {}
        for b in batches:
            for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist(), strict=True):
                words = re.findall(r"[^\W\d_]+", text)
                mine = best.setdefault(lang, {})
                for at in range(0, len(words), SEGMENT):
                    segment = " ".join(words[at : at + SEGMENT])
                    mine[xxhash.xxh3_64_intdigest(segment) >> 1] = segment
                if len(mine) > 4 * SEGMENTS:
                    best[lang] = {h: mine[h] for h in sorted(mine)[:SEGMENTS]}
        for lang, mine in best.items():
            keep = sorted(mine)[:SEGMENTS]
            yield {"lang": [lang] * len(keep), "hash": keep, "segment": [mine[h] for h in keep]}

    drawn = in_arrow(labelled.select("lang", "text"), "lang string, hash long, segment string", cut).distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "segment"))
    rows = drawn.withColumn("_rank", rank).where(F.col("_rank") <= SEGMENTS).drop("_rank")
    return sorted((r["lang"], r["segment"]) for r in rows.collect())


def fit(segments: list[tuple[str, str]]) -> Model | None:
    """Maximum likelihood with weight decay, by Adam over all segments."""
    langs = sorted({lang for lang, _ in segments})
    if not langs:
        return None
    k = len(langs)
    # Arrays over characters exist for a few segments at a time.
    parts = [[s for _, s in segments[at : at + 400]] for at in range(0, len(segments), 400)]
    each = [Words(p) for p in parts]
    word_names = np.concatenate([w.names() for w in each])
    chain = np.concatenate([w.text + 400 * i for i, w in enumerate(each)])
    counts = [w.count for w in each]
    del each
    label = np.array([langs.index(lang) for lang, _ in segments])[chain]
    names, first, type_of, times = np.unique(
        word_names, return_index=True, return_inverse=True, return_counts=True
    )
    is_first = np.zeros(len(chain), bool)
    is_first[first] = True
    grams, before = [], 0
    for p, n in zip(parts, counts, strict=True):
        mine, types = is_first[before : before + n], type_of[before : before + n]
        grams += [(b[mine[o]], types[o[mine[o]]].astype(np.int32)) for b, o in Words(p).grams()]
        before += n
    bucket = np.concatenate([b for b, _ in grams])
    owner = np.concatenate([o for _, o in grams])
    del grams
    common = times >= LEXICON_COUNT
    entry = np.cumsum(common) - 1
    n_common = int(common.sum())
    shapes = {"weights": (BUCKETS, k), "lexicon": (n_common, k), "moves": (k, k), "start": (k,)}
    theta = {name: np.zeros(s) for name, s in shapes.items()}
    mean = {name: np.zeros(s) for name, s in shapes.items()}
    square = {name: np.zeros(s) for name, s in shapes.items()}
    seen = np.zeros((len(chain), k))
    seen[np.arange(len(chain)), label] = 1
    starts = np.r_[True, np.diff(chain) != 0]
    begun = np.bincount(label[starts], minlength=k)
    same = ~starts[1:]
    moved = np.zeros((k, k))
    np.add.at(moved, (label[:-1][same], label[1:][same]), 1)
    for step in range(1, STEPS + 1):
        per_type = np.stack(
            [np.bincount(owner, theta["weights"][bucket, j], len(names)) for j in range(k)], axis=1
        )
        per_type[common] += theta["lexicon"]
        out, pairs, begins, _ = forward_backward(
            per_type[type_of], chain, theta["moves"], theta["start"], expected=True
        )
        by_type = np.stack([np.bincount(type_of, (seen - out)[:, j], len(names)) for j in range(k)], axis=1)
        grad = {
            "weights": np.stack([np.bincount(bucket, by_type[owner, j], BUCKETS) for j in range(k)], axis=1),
            "lexicon": by_type[common],
            "moves": moved - pairs,
            "start": begun - begins,
        }
        for name, g in grad.items():
            g = g / len(chain) - DECAY * theta[name]
            mean[name] = 0.9 * mean[name] + 0.1 * g
            square[name] = 0.99 * square[name] + 0.01 * g * g
            m, v = mean[name] / (1 - 0.9**step), square[name] / (1 - 0.99**step)
            theta[name] += RATE / step**0.5 * m / (np.sqrt(v) + 1e-8)
    return Model(
        langs,
        theta["weights"].astype(np.float32),
        names[common],
        theta["lexicon"].astype(np.float32)[entry[common]] if n_common else np.zeros((0, k), np.float32),
        theta["moves"],
        theta["start"],
    )


# --- prediction ------------------------------------------------------------------------


def label_words(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``lang_pred``, ``score``, ``runs``.

    ``labelled`` has texts with their language; rows where either is null teach nothing.
    ``runs`` are the maximal runs of words of one language, as (start, end, lang, words)
    with code point offsets, the end that of the next run's start or the text's. The
    prediction is the language with the largest mean probability over the text's words,
    ties to the first by name, and ``score`` that mean. Of ``docs`` nothing but the text
    is an input.

    A null text, or one without a letter, is ``und`` with score 0 and no runs, as is every
    text if nothing is labelled. Repeated rows are answered each. Other columns are not
    read.
    """
    known = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    model = fit(sample(known.where("lang is not null and text is not null")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    run = "start: int, end: int, lang: string, words: int"
    more = StructType.fromDDL(f"lang_pred string, score double, runs array<struct<{run}>>")
    schema = StructType([rows.schema["id"], *more])

    def predict(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            texts = b["text"].to_pylist()
            lang, score, runs = predicted(shared.value, texts)
            yield {"id": b["id"], "lang_pred": lang, "score": score, "runs": runs}

    return in_arrow(rows, schema, predict)


def predicted(model: Model | None, texts: list[str | None]):
    n = len(texts)
    lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
    empty = pa.array([[]] * n, pa.list_(_run_type()))
    if model is None or not n:
        return lang.tolist(), score, empty
    words = Words(texts)
    if not words.count:
        return lang.tolist(), score, empty
    m = model.marginals(words)
    first = np.flatnonzero(np.r_[True, np.diff(words.text) != 0])
    sizes = np.diff(np.r_[first, words.count])
    means = np.add.reduceat(m, first, axis=0) / sizes[:, None]
    best = means.argmax(axis=1)
    who = words.text[first]
    lang[who] = np.array(model.langs, object)[best]
    score[who] = np.clip(means[np.arange(len(best)), best], 0, 1)
    return lang.tolist(), score, _runs(model, words, m.argmax(axis=1), np.array([len(t or "") for t in texts]))


def _run_type() -> pa.DataType:
    return pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("words", pa.int32())])


def _runs(model: Model, words: Words, label: np.ndarray, lengths: np.ndarray) -> pa.Array:
    new = np.flatnonzero(np.r_[True, (np.diff(words.text) != 0) | (np.diff(label) != 0)])
    text = words.text[new]
    start = words.places[new]
    last = np.r_[text[1:] != text[:-1], True]
    end = np.where(last, lengths[text], np.r_[start[1:], 0])
    langs = pa.array(model.langs, pa.string()).take(pa.array(label[new]))
    count = np.diff(np.r_[new, words.count])
    flat = pa.StructArray.from_arrays(
        [pa.array(start, pa.int32()), pa.array(end, pa.int32()), langs, pa.array(count, pa.int32())],
        fields=list(_run_type()),
    )
    offsets = np.r_[0, np.cumsum(np.bincount(text, minlength=len(lengths)))]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
