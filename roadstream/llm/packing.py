"""Packing token sequences into windows by non-negative least squares.

Whole windows are cut off a document; what is left of it is shorter than a window. The
histogram of these lengths decides how they meet: pairs and triples of lengths that fill a
window exactly are enumerated, repeat counts are solved for against the histogram and
rounded, and the residual counts are packed greedily, largest first, many windows of one
pattern at a time. Histogram and patterns are bounded by the window, whatever the corpus;
pieces are numbered within their length by Spark and look their window up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstream.llm.common import in_arrow, numbered, written
from roadstream.llm.tokens import encoder, with_end

ITERATIONS = 300


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 1024,
    with_ids: bool = False,
) -> DataFrame:
    """Per piece: ``id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``, and with ``with_ids`` the token ids as ``ids`` (unsigned
    32-bit numbers, little-endian).

    A document is its ids and a closing id 0; a null text is an empty one, so that every
    row has a piece. Each id lies in one piece, pieces of a sequence follow one another
    without gaps from offset 0, and a sequence holds at most ``window`` ids; ids short of
    ``window`` are padding. Repeated rows are packed each. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cut = written(_pieces(rows, tokenizer, window, with_ids).withColumn("_no", F.monotonically_increasing_id()))
    # At most a row a length.
    counts = np.zeros(window + 1, np.int64)
    for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["length"]] = r["n"]
    places = Places(plan(counts, window))
    keyed = cut.drop("ids") if with_ids else cut
    placed = _placed(numbered(keyed, ["length"], ["_no"], "_rank"), places)
    if with_ids:
        placed = placed.join(cut.select("_no", "ids"), "_no")
    return placed.drop("_no", "_rank")


def _pieces(rows: DataFrame, tokenizer: str, window: int, with_ids: bool) -> DataFrame:
    names = ["start", "length", "ids_crc32", "doc_tokens"]
    schema = StructType([rows.schema["id"]])
    for name in names:
        schema = schema.add(name, "long")
    if with_ids:
        schema = schema.add("ids", "binary")

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        encode = encoder(tokenizer)
        for b in batches:
            out, at = [], []
            for i, text in enumerate(b["text"].to_pylist()):
                ids = with_end(encode(text or ""))
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window].tobytes()
                    at.append(i)
                    out.append((start, len(piece) // 4, zlib.crc32(piece), len(ids), piece))
            columns = list(zip(*out, strict=True)) or [()] * 5
            done = {"id": b["id"].take(pa.array(at, pa.int64()))}
            done |= {n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=False)}
            yield done | ({"ids": list(columns[4])} if with_ids else {})

    return in_arrow(rows, schema, cut)


# --- which lengths meet ----------------------------------------------------------------


def fillings(counts: np.ndarray, window: int) -> np.ndarray:
    """Pairs and triples (a <= b <= c, a = 0 for pairs) of lengths in stock that fill a
    window."""
    here = np.flatnonzero(counts[:window])
    here = here[here > 0]
    a, b = np.meshgrid(np.r_[0, here], here, indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = window - a - b
    fits = (a <= b) & (b <= c) & (c > 0)
    a, b, c = a[fits], b[fits], c[fits]
    stock = counts[c] > 0
    return np.stack([a[stock], b[stock], c[stock]], axis=1)


def repeats(ways: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared distance between the lengths used
    and ``counts``, by accelerated projected gradients."""
    size = len(counts)
    use = counts.astype(np.float64).copy()
    use[0] = 0

    def used(x):
        out = sum(np.bincount(ways[:, k], x, size) for k in range(3))
        out[0] = 0
        return out

    # The largest eigenvalue of A'A is at most the largest column sum of its entries.
    load = used(np.ones(len(ways)))
    step = 1.0 / max((load[ways[:, 0]] + load[ways[:, 1]] + load[ways[:, 2]]).max(), 1.0)
    x = np.zeros(len(ways))
    y, t = x.copy(), 1.0
    for _ in range(ITERATIONS):
        left = used(y) - use
        grad = left[ways[:, 0]] + left[ways[:, 1]] + left[ways[:, 2]]
        new = np.maximum(y - step * grad, 0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(counts: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many windows have each; they use up ``counts``."""
    left = counts.astype(np.int64).copy()
    out = [((window,), int(left[window]))] if left[window] else []
    left[window] = 0
    ways = fillings(left, window)
    if len(ways):
        x = repeats(ways, left)
        order = np.argsort(-x, kind="stable")
        # Rounded along the running sum, so that many small shares keep their total.
        wanted = np.diff(np.floor(np.cumsum(x[order]) + 0.5), prepend=0).astype(np.int64)
        for k, most in zip(order[wanted > 0], wanted[wanted > 0], strict=True):
            way = tuple(int(v) for v in ways[k] if v)
            n = min(int(most), *(int(left[v]) // way.count(v) for v in way))
            if n > 0:
                out.append((way, n))
                for v in way:
                    left[v] -= n
    return out + _greedy(left, window)


def _greedy(left: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Largest first, each time the largest that still fits. A pattern is repeated as long
    as its lengths last, so that a step uses a length up."""
    out = []
    while left.any():
        room, way = window, {}
        size = int(np.flatnonzero(left)[-1])
        while size:
            k = min(int(left[size]), room // size)
            way[size] = k
            room -= k * size
            rest = np.flatnonzero(left[: min(room, size - 1) + 1])
            size = int(rest[-1]) if len(rest) else 0
        n = min(int(left[v]) // k for v, k in way.items())
        out.append((tuple(v for v, k in way.items() for _ in range(k)), n))
        for v, k in way.items():
            left[v] -= n * k
    return out


class Places:
    """Where the k-th piece of a length lies: its window and its offset there."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]]):
        taken: dict[int, int] = {}
        rows, base = [], 0
        for way, n in patterns:
            offset = 0
            for size in way:
                rows.append((size, taken.get(size, 0), base, offset))
                taken[size] = taken.get(size, 0) + n
                offset += size
            base += n
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.key = (table[:, 0] << 44) | table[:, 1]
        self.first, self.base, self.offset = table[:, 1], table[:, 2], table[:, 3]

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 44) | rank, "right") - 1
        return self.base[at] + rank - self.first[at], self.offset[at]


def _placed(ranked: DataFrame, places: Places) -> DataFrame:
    shared = ranked.sparkSession.sparkContext.broadcast(places)

    @F.pandas_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        if not len(length):
            return pd.DataFrame({"sequence_id": [], "offset": []}, dtype="int64")
        sequence, offset = shared.value.find(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    found = ranked.withColumn("_place", place("length", "_rank"))
    return found.select(*ranked.columns, "_place.sequence_id", "_place.offset")
