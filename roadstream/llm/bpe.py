"""Byte-pair encoding by an index of pair occurrences, and decoding.

A partition's texts are taken in blocks. A block's distinct words that were not met before
are laid out symbol after symbol, and every pair of neighbours is mapped to all its positions.
Pairs with a rank wait in a heap; the lowest rank is applied to all its positions at once, and
only the lists of the pairs beside them change. So a merge costs its occurrences among
distinct words, not a scan of each word, and each word of the partition is merged once.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType
from tokenizers import Tokenizer

from roadstream.llm.common import in_arrow
from roadstream.llm.tokens import _byte_of_symbol

#: Characters of text that are indexed together, and distinct chunks remembered between blocks.
BLOCK_CHARS, REMEMBERED = 4 << 20, 300_000

#: Unicode's white space, on which words never span.
WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_CONTROL = regex.compile(r"[\x1c-\x1f]")
_CHUNK = regex.compile(WHITE.replace("[", "[^", 1) + "+")


@dataclass
class Vocabulary:
    """What a tokenizer file of words with word ends says. ``symbols`` and ``last`` hold the id
    of every byte within and at the end of a word, ``first`` the ranks of their pairs."""

    words: regex.Pattern
    symbols: np.ndarray
    last: np.ndarray
    row: np.ndarray
    first: np.ndarray
    rules: list[tuple[int, int, int]]
    to_right: dict[int, dict[int, int]]
    to_left: dict[int, dict[int, int]]
    tokens: list[str]
    added: dict[str, int]
    split: regex.Pattern | None
    path: str

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)


def _wanted(spec: dict) -> str | None:
    """Why a file cannot be run here, or None."""
    model, normal = spec["model"], spec.get("normalizer") or {}
    before = spec.get("pre_tokenizer") or {}
    kinds = [n["type"] for n in normal.get("normalizers", [])]
    steps = before.get("pretokenizers", [])
    if model.get("type") != "BPE" or not model.get("end_of_word_suffix") or model.get("continuing_subword_prefix"):
        return "a BPE with word ends"
    if model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback") or model.get("unk_token"):
        return "no dropout, byte fallback or unknown token"
    if kinds != ["NFC", "Replace", "Lowercase"] or normal["normalizers"][1]["pattern"] != {"Regex": r"\s+"}:
        return "NFC, white space as blanks, lower case"
    if [s["type"] for s in steps] != ["Split", "ByteLevel"] or steps[1].get("use_regex", True) or steps[1].get("add_prefix_space"):
        return "a split into words, then bytes"
    if steps[0]["behavior"] != "Removed" or not steps[0]["invert"]:
        return "a split that keeps what matches"
    if spec.get("decoder"):
        return "no decoder"
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec.get("added_tokens", [])):
        return "added tokens that stand for themselves"
    return None


def vocabulary(path: str) -> Vocabulary:
    """Read a file; one of another kind is an error that names what is expected."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    wanted = _wanted(spec)
    if wanted:
        raise ValueError(f"{path}: expected {wanted}")
    model = spec["model"]
    ids, end = model["vocab"], model["end_of_word_suffix"]
    pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
    rules, to_right, to_left = [], {}, {}
    made = {a + b: rank for rank, (a, b) in enumerate(pairs)}
    for rank, (a, b) in enumerate(pairs):
        if max(made.get(a, -1), made.get(b, -1)) >= rank or made[a + b] != rank:
            raise ValueError(f"{path}: expected merges of what earlier merges made")
        left, right = ids[a], ids[b]
        rules.append((left, right, ids[a + b]))
        to_right.setdefault(left, {})[right] = to_left.setdefault(right, {})[left] = rank
    symbols = sorted(_byte_of_symbol(), key=_byte_of_symbol().get)
    single = np.array([ids[c] for c in symbols] + [ids[c + end] for c in symbols])
    row = np.zeros(max(ids.values()) + 1, np.int64)
    row[single] = np.arange(len(single))
    first = np.full((len(single), len(single)), -1)
    for rank, (left, right, _) in enumerate(rules):
        if single[row[left]] == left and single[row[right]] == right:
            first[row[left], row[right]] = rank
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    tokens = {i: t for t, i in ids.items()} | {i: t for t, i in added.items()}
    return Vocabulary(
        words=regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]),
        symbols=single[:256],
        last=single[256:],
        row=row,
        first=first,
        rules=rules,
        to_right=to_right,
        to_left=to_left,
        tokens=[tokens.get(i, "") for i in range(max(tokens) + 1)],
        added=added,
        path=path,
        split=regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None,
    )


#: Letters up to here are the same in all versions of Unicode; what lies beyond is left to the
#: file's own normaliser and splitter.
_SETTLED = regex.compile(r"[\x00-\u024f]*")


def merged(words: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """The ids of every word, as 32-bit numbers, by one index over all of them."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    of_byte = np.frombuffer(b"".join(words), np.uint8)
    symbols = vocab.symbols[of_byte]
    symbols[ends - 1] = vocab.last[of_byte[ends - 1]]
    after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
    after[ends - 1], before[ends - lengths] = -1, -1
    ids, after, before = symbols.tolist(), after.tolist(), before.tolist()
    places = _occurrences(symbols, ends, vocab)
    none: dict[int, int] = {}
    to_right, to_left = vocab.to_right, vocab.to_left
    active = list(places)
    heapq.heapify(active)
    while active:
        rank = heapq.heappop(active)
        left, right, new = vocab.rules[rank]
        rights, lefts = to_right.get(new, none), to_left.get(new, none)
        # From left to right, as of overlapping pairs the first is merged.
        for at in sorted(places.pop(rank)):
            then = after[at]
            if then < 0 or ids[at] != left or ids[then] != right:
                continue  # an earlier merge took one of the two
            ids[at], ids[then] = new, -1
            after[at] = ahead = after[then]
            if ahead >= 0:
                before[ahead] = at
                made = rights.get(ids[ahead])
                if made in places:
                    places[made].append(at)
                elif made is not None:
                    places[made] = [at]
                    heapq.heappush(active, made)
            if lefts and (behind := before[at]) >= 0:
                made = lefts.get(ids[behind])
                if made in places:
                    places[made].append(behind)
                elif made is not None:
                    places[made] = [behind]
                    heapq.heappush(active, made)
    # A merged symbol stands where its left part stood, so that ids are in order.
    left_over = np.array(ids, np.int32)
    tokens = left_over[left_over >= 0]
    cuts = np.concatenate([[0], np.cumsum(left_over >= 0)[ends - 1]]) * 4
    flat = tokens.tobytes()
    return [flat[a:b] for a, b in pairwise(cuts.tolist())]


def _occurrences(symbols: np.ndarray, ends: np.ndarray, vocab: Vocabulary) -> dict[int, list[int]]:
    """All positions of every pair of neighbours in a word that has a rank, by rank."""
    ranks = vocab.first[vocab.row[symbols[:-1]], vocab.row[symbols[1:]]]
    ranks[ends[:-1] - 1] = -1
    at = np.flatnonzero(ranks >= 0)
    at = at[np.argsort(ranks[at], kind="stable")]
    of, starts = np.unique(ranks[at], return_index=True)
    cuts = [*starts.tolist(), len(at)]
    return {rank: at[a:b].tolist() for rank, (a, b) in zip(of.tolist(), pairwise(cuts), strict=True)}


@dataclass
class Encoder:
    """A partition's chunks (what stands between white space) and their ids."""

    vocab: Vocabulary
    chunks: dict[str, bytes] = field(default_factory=dict)
    words: dict[str, bytes] = field(default_factory=dict)

    def _start(self) -> None:
        self.chunks.clear()
        self.words.clear()
        self.words.update((t, array("i", [i]).tobytes()) for t, i in self.vocab.added.items())

    def learn(self, chunks: Iterable[str]) -> None:
        """Encode the chunks that are not known yet."""
        if not self.chunks or len(self.chunks) > REMEMBERED:
            self._start()
        fresh = list(set(chunks) - self.chunks.keys())
        parts = self._words(fresh)
        new = list(set(chain.from_iterable(parts)) - self.words.keys())
        found = merged([w.encode() for w in new], self.vocab) if new else []
        self.words.update(zip(new, found, strict=True))
        self.chunks.update((c, b"".join([self.words[p] for p in ps])) for c, ps in zip(fresh, parts, strict=True))

    def _words(self, chunks: list[str]) -> list[list[str]]:
        """The words and added tokens of every chunk."""
        vocab = self.vocab
        # Chunks hold no white space, so that many are normalised and split as lines of one text.
        plain = [c for c in chunks if _SETTLED.fullmatch(c) and not (vocab.split and vocab.split.search(c))]
        lines = unicodedata.normalize("NFC", "\n".join(plain)).lower().split("\n")
        found = dict(zip(plain, map(vocab.words.findall, lines), strict=False))
        return [found[c] if c in found else self._parts(c) for c in chunks]

    def _parts(self, chunk: str) -> list[str]:
        """The same for a chunk with added tokens or letters that the file's own parts know."""
        vocab, out = self.vocab, []
        for piece in vocab.split.split(chunk) if vocab.split else [chunk]:
            if piece in vocab.added:
                out.append(piece)
            elif piece:
                normal = vocab.library.normalizer.normalize_str(piece)
                out += vocab.library.pre_tokenizer[0].pre_tokenize_str(normal)
        return [p if isinstance(p, str) else p[0] for p in out]


def _chunks(text: str) -> list[str]:
    """What stands between white space. Python also splits at four control characters."""
    return _CHUNK.findall(text) if _CONTROL.search(text) else text.split()


def _block_ids(texts: list[str | None], encoder: Encoder) -> pa.ListArray:
    split = [_chunks(t) if t else [] for t in texts]
    encoder.learn(chain.from_iterable(split))
    known, parts, ends = encoder.chunks, [], [0]
    for chunks in split:
        parts.append(b"".join([known[c] for c in chunks]))
        ends.append(ends[-1] + len(parts[-1]) // 4)
    flat = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id`` and ``ids``, the token ids of its whole text without special
    tokens added.

    ``tokenizer`` is a JSON file of a BPE with word ends, read by every task (it must be at
    that place on every machine). The strings of its added tokens are these tokens, also in
    a text. A null or empty text has no ids. A very long one is a block of its own. Repeated
    rows are encoded each; of equal pairs that overlap the first is merged. An empty table gives
    an empty one. Other columns are not read.
    """
    vocabulary(tokenizer)  # an unsuitable file is refused before a task starts
    schema = StructType([*docs.select(F.col(id_col).alias("id")).schema]).add("ids", ArrayType(IntegerType(), False))

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        encoder = Encoder(vocabulary(tokenizer))
        for ids, texts in _blocks(batches):
            yield {"id": ids, "ids": _block_ids(texts, encoder)}

    return in_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), schema, work)


def _blocks(batches: Iterator[dict]) -> Iterator[tuple[pa.Array, list]]:
    """Rows of a partition, ``BLOCK_CHARS`` of text or a single row at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        ids.append(batch["id"])
        texts += (rows := batch["text"].to_pylist())
        size += sum(len(t) for t in rows if t)
        if size >= BLOCK_CHARS:
            yield pa.concat_arrays(ids), texts
            ids, texts, size = [], [], 0
    if ids:
        yield pa.concat_arrays(ids), texts


def decoded(rows: DataFrame, tokenizer: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text of their token ids as ``name``.

    As the file names no decoder, tokens are joined by blanks, special ones included; ids
    beyond the vocabulary and null ones are left out, and null ids give a null text."""
    # Tokens hold no white space: one literal, which is split once while the plan is made.
    tokens = F.split(F.lit("\t".join(vocabulary(tokenizer).tokens)), "\t")
    return rows.withColumn(name, F.array_join(F.transform(ids_col, lambda i: F.get(tokens, i)), " "))


def digests(rows: DataFrame) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded rows."""
    numbers = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select(
        "id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
