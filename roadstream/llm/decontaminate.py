"""Benchmark passages in documents, found in a latent space and checked word by word.

Documents become arrays of term numbers, where only terms of the benchmark have one: others
add nothing to a product with an item. Passages of TF-IDF weights are reduced by a
randomised SVD whose Gram products are summed by Spark; windows of a document whose cosine
with an item is high are compared by longest common subsequence and by the item's answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstream.llm.common import in_arrow, written

#: Words of half a window; windows overlap by half.
HALF = 16
#: Dimensions that are kept, and those that the sketch has besides.
RANK, EXTRA = 160, 16
#: A term in a larger share of passages has no weight, unless an item has no better ones.
MAX_DF, RAREST = 0.03, 8
#: Bytes of benchmark text that are searched for in one go.
BLOCK_BYTES = 8 << 20
#: Gram products of a term are added up in two steps of this many parts.
PARTS, TERMS = 32, 64

_SPACED = bytes(
    c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation and white space part them."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPACED).split()


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    cosine: float = 0.55,
    coverage: float = 0.8,
    coverage_with_answer: float = 0.6,
) -> DataFrame:
    """Per document and item that leaks into it: ``id``, ``item_id``, ``start``, ``end``,
    ``cosine``, ``coverage``, ``answered``.

    A window of words is a candidate if its cosine with the item in the latent space
    reaches ``cosine``. It is
    a leak if the longest common subsequence of the item and the words around the window
    covers ``coverage`` of the item, or ``coverage_with_answer`` while the answer stands
    there word for word. The answer is ``answer_col`` or else the item's last five words.
    The window with the largest coverage is returned, ties to the first; ``start`` and
    ``end`` are word offsets of the region compared.

    Null and empty texts leak nothing, items without words are not searched for. Repeated
    rows of documents are answered each, items with equal text under each id, repeated
    items once. Other columns are not read.
    """
    items = benchmark.select(
        F.col(item_id_col).alias("item_id"),
        F.col(item_text_col).alias("text"),
        (F.col(answer_col) if answer_col else F.lit(None)).cast("string").alias("answer"),
    ).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = None
    for i in range(blocks):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == i)
        now = _against(rows, _Items(part.toArrow()), cosine, coverage, coverage_with_answer)
        found = now if found is None else found.unionByName(now)
    return found.withColumn("item_id", F.col("item_id").cast(items.schema["item_id"].dataType))


class _Items:
    """A block of the benchmark."""

    def __init__(self, got: pa.Table):
        self.ids, self.words, self.answers = [], [], []
        for row in got.to_pylist():
            w = words(row["text"])
            if w:
                self.ids.append(None if row["item_id"] is None else str(row["item_id"]))
                self.words.append(w)
                self.answers.append(words(row["answer"]) or w[-5:])
        terms = sorted({x for w in self.words for x in w})
        self.number = {x: i for i, x in enumerate(terms)}
        self.rows = [np.array([self.number[x] for x in w], np.int32) for w in self.words]


def _against(rows: DataFrame, items: _Items, cosine, coverage, with_answer) -> DataFrame:
    numbered = written(_numbered(rows, items.number))
    size = len(items.number)
    df, passages = _frequencies(numbered, size)
    weight = _weights(items, df, passages)
    basis = _latent(numbered, items, weight)
    return _matches(numbered, items, weight, basis, cosine, coverage, with_answer)


# --- terms -----------------------------------------------------------------------------


def _numbered(rows: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(id, terms): a text's words as 32-bit numbers from 1, 0 where no item has the word.
    Texts with none are left out."""
    shared = rows.sparkSession.sparkContext.broadcast(number)

    def read(batches: Iterator[dict]) -> Iterator[dict]:
        get = shared.value.get
        for b in batches:
            out, at = [], []
            for i, text in enumerate(b["text"].to_pylist()):
                w = words(text)
                got = np.fromiter((get(x, -1) for x in w), np.int32, len(w))
                if len(got) and got.max() >= 0:
                    at.append(i)
                    out.append((got + 1).astype(np.int32).tobytes())
            yield {"id": b["id"].take(pa.array(at, pa.int64())), "terms": out}

    return in_arrow(rows, StructType([rows.schema["id"]]).add("terms", "binary"), read)


def _laid_out(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after another, each filled to whole half windows: the terms, and each
    text's first half window and number of words."""
    texts = [np.frombuffer(x, np.int32) for x in column.to_pylist()]
    lengths = np.array([len(x) for x in texts], np.int64)
    halves = -(-lengths // HALF)
    first = np.cumsum(halves) - halves
    flat = np.zeros(int(halves.sum()) * HALF, np.int32)
    for x, at in zip(texts, first, strict=True):
        flat[at * HALF : at * HALF + len(x)] = x
    return flat, first, lengths


def _frequencies(numbered: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many passages (disjoint windows) each term occurs, and their number."""

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        df, n = np.zeros(size + 1, np.int64), 0
        for b in batches:
            flat, _, _ = _laid_out(b["terms"])
            n += -(-len(flat) // (2 * HALF))
            at = np.flatnonzero(flat)
            both = np.unique((at // (2 * HALF)) * (size + 1) + flat[at])
            df += np.bincount(both % (size + 1), minlength=size + 1)
        df[0] = n
        seen = np.flatnonzero(df)
        yield {"term": seen, "n": df[seen]}

    sums = in_arrow(numbered.select("terms"), "term int, n long", count).groupBy("term")
    out = np.zeros(size + 1, np.int64)
    # One row a term of the block.
    for r in sums.agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out[1:], int(out[0])


def _weights(items: _Items, df: np.ndarray, passages: int) -> np.ndarray:
    """Inverse document frequency by term number; index 0 is the word of no item."""
    idf = np.log((1 + passages) / (1 + df)) + 1
    use = df <= MAX_DF * passages
    for row in items.rows:
        distinct = np.unique(row)
        use[distinct[np.argsort(df[distinct], kind="stable")[:RAREST]]] = True
    return np.concatenate([[0], np.where(use, idf, 0)]).astype(np.float32)


# --- latent space ----------------------------------------------------------------------


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of ``values`` with the same key; ``keys`` are sorted."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(values, starts, axis=0)


def _gram(numbered: DataFrame, items: _Items, weight: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A'A right for the TF-IDF passages A of all documents, and the items.

    Items count as much as all passages together, so that the space keeps what tells them
    apart. Tasks send partial sums by chunk of terms; they are added in two steps."""
    size, width = right.shape
    shared = numbered.sparkSession.sparkContext.broadcast((weight, right.astype(np.float32)))

    def product(batches: Iterator[dict]) -> Iterator[dict]:
        w, omega = shared.value
        weighed = omega * w[:, None]
        total, part = np.zeros((size, width), np.float32), 0
        for b in batches:
            flat, _, _ = _laid_out(b["terms"])
            at = np.flatnonzero(w[flat])
            part += len(flat)
            for lo, hi in _cuts(at // (2 * HALF), 512, again=False):
                cut = at[lo:hi]
                seen, term = np.unique(flat[cut], return_inverse=True)
                passage = np.cumsum(np.diff(cut // (2 * HALF), prepend=-1) > 0) - 1
                # How often each of these few passages has each of its terms.
                shape = (int(passage[-1]) + 1, len(seen))
                times = np.bincount(passage * shape[1] + term, minlength=shape[0] * shape[1])
                times = times.reshape(shape).astype(np.float32)
                total[seen] += times.T @ (times @ weighed[seen])
        total *= w[:, None]
        for lo in range(0, size, TERMS):
            piece = total[lo : lo + TERMS]
            if piece.any():
                yield {"chunk": [lo], "part": [part % PARTS], "sums": [piece.tobytes()]}

    def added(pieces: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in pieces["sums"].to_pylist())
        return pa.table(
            {
                "chunk": pieces["chunk"].slice(0, 1).cast(pa.int32()),
                "part": pieces["part"].slice(0, 1).cast(pa.int32()),
                "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary()),
            }
        )

    schema = "chunk int, part int, sums binary"
    pieces = in_arrow(numbered.select("terms"), schema, product)
    some = pieces.groupBy("chunk", "part").applyInArrow(added, schema)
    all_ = some.groupBy("chunk").applyInArrow(added, schema)
    out = np.zeros((size, width))
    # The terms of a block times the sketch's width.
    for r in all_.collect():
        x = np.frombuffer(bytes(r["sums"]), np.float32).reshape(-1, width)
        out[r["chunk"] : r["chunk"] + len(x)] = x
    own = _item_vectors(items, weight)
    mass = np.trace(right.T @ out) / max(np.trace(right.T @ (own.T @ (own @ right))), 1e-9)
    return out + max(mass, 1.0) * (own.T @ (own @ right))


def _item_vectors(items: _Items, weight: np.ndarray) -> np.ndarray:
    own = np.zeros((len(items.rows), len(weight)))
    for i, row in enumerate(items.rows):
        np.add.at(own[i], row + 1, weight[row + 1])
    return own


def _latent(numbered: DataFrame, items: _Items, weight: np.ndarray) -> np.ndarray:
    """The leading right singular vectors (terms by RANK), by subspace iteration from a
    random sketch and a Rayleigh-Ritz step."""
    size = len(weight)
    rank = min(RANK, size)
    sketch = np.random.default_rng(9).standard_normal((size, min(RANK + EXTRA, size)))
    q, _ = np.linalg.qr(_gram(numbered, items, weight, sketch))
    values, vectors = np.linalg.eigh(q.T @ _gram(numbered, items, weight, q))
    return (q @ vectors[:, np.argsort(values)[::-1][:rank]]).astype(np.float32)


# --- search ----------------------------------------------------------------------------


def common_subsequence(item_bits: dict[int, int], n: int, region: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit per word of the item."""
    full = (1 << n) - 1
    v = full
    for x in region:
        u = v & item_bits.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _matches(numbered, items: _Items, weight, basis, cosine, coverage, with_answer) -> DataFrame:
    own = _item_vectors(items, weight)
    latent = own @ basis
    latent = (latent / np.maximum(np.linalg.norm(latent, axis=1), 1e-9)[:, None]).astype(np.float32)
    bits = []
    for row in items.rows:
        one: dict[int, int] = {}
        for i, x in enumerate(row):
            one[int(x) + 1] = one.get(int(x) + 1, 0) | 1 << i
        bits.append(one)
    lengths = np.array([len(r) for r in items.rows], np.int64)
    answers = [
        np.array([items.number.get(x, -1) + 1 for x in a], np.int32).tobytes() for a in items.answers
    ]
    shared = numbered.sparkSession.sparkContext.broadcast(
        (weight, basis * weight[:, None], latent, bits, lengths, answers, items.ids)
    )
    names = ("item_id", "start", "end", "cosine", "coverage", "answered")
    kinds = ("string", "long", "long", "double", "double", "boolean")
    schema = StructType([numbered.schema["id"]])
    for name, kind in zip(names, kinds, strict=True):
        schema = schema.add(name, kind)

    def search(batches: Iterator[dict]) -> Iterator[dict]:
        w, weighed, latent, bits, lengths, answers, ids = shared.value
        for b in batches:
            flat, first, counts = _laid_out(b["terms"])
            best: dict[tuple[int, int], tuple] = {}
            for window, item, cos in _near(flat, weighed, latent, cosine):
                text = int(np.searchsorted(first, window, "right")) - 1
                start = int(first[text]) * HALF
                n = int(lengths[item])
                lo = max(start, window * HALF - n)
                hi = min(start + int(counts[text]), (window + 2) * HALF + n)
                if lo >= hi:
                    continue
                region = flat[lo:hi]
                got = common_subsequence(bits[item], n, region.tolist()) / n
                there = _holds(region, answers[item])
                if got >= (with_answer if there else coverage):
                    key = (text, int(item))
                    if key not in best or got > best[key][3]:
                        best[key] = (lo - start, hi - start, float(cos), got, there)
            at = [k[0] for k in best]
            out = {"id": b["id"].take(pa.array(at, pa.int64())), "item_id": [ids[k[1]] for k in best]}
            for i, name in enumerate(names[1:]):
                out[name] = [v[i] for v in best.values()]
            yield out

    return in_arrow(numbered, schema, search)


def _holds(region: np.ndarray, answer: bytes) -> bool:
    """Does the answer stand in the region word for word?"""
    data, at = region.tobytes(), -1
    while (at := data.find(answer, at + 1)) >= 0:
        if at % 4 == 0:
            return True
    return False


def _near(flat, weighed, latent, cosine: float):
    """(first half window, item, cosine) of the candidate windows, in order."""
    if not len(latent):
        return
    at = np.flatnonzero(weighed.any(axis=1)[flat])
    for lo, hi in _cuts(at // HALF):
        cut = at[lo:hi]
        half, sums = _sums(cut // HALF, weighed[flat[cut]])
        # A window is a half and the one after it, if that has any weight.
        follows = np.r_[half[1:] == half[:-1] + 1, False]
        u = sums.copy()
        u[follows] += sums[1:][follows[:-1]]
        scores = (u @ latent.T) / np.maximum(np.linalg.norm(u, axis=1), 1e-9)[:, None]
        hit, item = np.nonzero(scores >= cosine)
        yield from zip(half[hit].tolist(), item.tolist(), scores[hit, item].tolist(), strict=True)


def _cuts(halves: np.ndarray, most: int = 2000, again: bool = True) -> Iterator[tuple[int, int]]:
    """Ranges of about ``most`` entries that part no half window; with ``again`` each begins
    anew with the last half of the range before, so that no pair of halves is lost."""
    lo, n = 0, len(halves)
    while lo < n:
        hi = min(n, lo + max(most, 4 * HALF))
        if hi < n:
            hi = int(np.searchsorted(halves, halves[hi - 1], "right"))
        yield lo, hi
        if hi >= n:
            return
        lo = int(np.searchsorted(halves, halves[hi - 1], "left")) if again else hi
