"""Periodic runs of words, located by block convolution.

A run repeats itself at least four times, so at the scale of its period it holds a whole
block that occurs again one period on. At each dyadic scale the blocks of a text are compared
with the windows that follow them: an exact number-theoretic transform gives the sum of
squared differences at every distance of the scale, and a sum of zero is an occurrence. Its
distance is the seed of a stretch, which is extended word by word in both directions.

Sums are taken modulo a prime: none that is zero is missed, and one that is zero by chance is
refused when its block is compared. Blocks with a word that does not return within the
window, and blocks inside a run that is known, are not transformed; neither holds a new seed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import compress, count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstream.llm.common import in_arrow

#: A run covers its period this often, and has so many words, at least.
REPEATS, SHORTEST = 4, 6

#: A prime p = 15 * 2**27 + 1 and a generator of its units.
PRIME, GENERATOR = 2013265921, 31
_P = np.uint64(PRIME)

#: Numbers that are transformed at once.
BATCH = 1 << 18

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


@cache
def _powers(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order ``2 * half``."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    out = np.ones(half, np.uint64)
    known = 1
    while known < half:
        out[known : 2 * known] = out[:known] * np.uint64(pow(root, known, PRIME)) % _P
        known *= 2
    return out


def _reduced(x: np.ndarray) -> np.ndarray:
    return np.minimum(x, x - _P)  # below zero wraps to a large number


def transform(x: np.ndarray) -> np.ndarray:
    """The number-theoretic transform of each row, in bit-reversed order."""
    half = x.shape[1] // 2
    while half:
        parts = x.reshape(len(x), -1, 2, half)
        a, b = parts[:, :, 0], parts[:, :, 1]
        x = np.stack([_reduced(a + b), (a + _P - b) * _powers(half, False) % _P], axis=2)
        half //= 2
    return x.reshape(len(x), -1)


def untransform(x: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``, from that order."""
    rows, size = x.shape
    half = 1
    while half < size:
        parts = x.reshape(rows, -1, 2, half)
        a, b = parts[:, :, 0], parts[:, :, 1] * _powers(half, True) % _P
        x = np.stack([_reduced(a + b), _reduced(a + _P - b)], axis=2)
        half *= 2
    return x.reshape(rows, size) * np.uint64(pow(size, -1, PRIME)) % _P


def occurrences(ids: np.ndarray, starts: np.ndarray, block: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks and the distances, from ``least`` to ``most``, at which a block has no
    mismatch with the words that follow it."""
    n, size = len(ids), 4 * block
    words = np.zeros(n + size, np.uint64)
    words[:n] = ids
    squares = np.zeros(n + size + 1, np.uint64)
    np.cumsum(words * words % _P, out=squares[1:])
    distances = np.arange(least, most + 1)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    step = max(1, BATCH // size)
    for k in range(0, len(starts), step):
        at = starts[k : k + step, None]
        pattern = np.zeros((len(at), size), np.uint64)
        pattern[:, :block] = words[at + np.arange(block)[::-1]]
        window = np.zeros_like(pattern)
        window[:, : block + most] = words[at + np.arange(block + most)]
        products = untransform(transform(pattern) * transform(window) % _P)[:, block - 1 + distances]
        own = squares[at + block] - squares[at]
        theirs = squares[at + distances + block] - squares[at + distances]
        zero = ((own + theirs) % _P == 2 * products % _P) & (at + distances + block <= n)
        row, column = np.nonzero(zero)
        found.append((at[row, 0], distances[column]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (starts[:0], starts[:0])


def _agrees(ids: np.ndarray, at: int, period: int, step: int) -> int:
    """Words in a row, from ``at`` on in steps of 1 or back in steps of -1, that equal the
    word a period later."""
    limit = len(ids) - period - at if step > 0 else at + 1
    done, size = 0, 16
    while done < limit:
        take = min(size, limit - done)
        low = at + done if step > 0 else at - done - take + 1
        differ = ids[low : low + take] != ids[low + period : low + period + take]
        if step < 0:
            differ = differ[::-1]
        if differ.any():
            return done + int(differ.argmax())
        done, size = done + take, 2 * size
    return limit


def _divisors(period: int) -> Iterator[int]:
    """``period`` divided by each of its prime factors."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            yield period // factor
            while rest % factor == 0:
                rest //= factor
        factor += 1


def _held(runs: list[tuple[int, int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a run holds all words from a start to its end."""
    if not runs:
        return np.zeros(len(starts), bool)
    spans = np.array(sorted((s, s + length) for s, length, _ in runs))
    reach = np.maximum.accumulate(spans[:, 1])
    before = np.searchsorted(spans[:, 0], starts, side="right")
    return (before > 0) & (reach[before - 1] >= ends)


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period. ``ids`` are positive
    and tell words apart."""
    n = len(ids)
    runs: list[tuple[int, int, int]] = []
    if n < SHORTEST:
        return runs
    order = np.argsort(ids, kind="stable")
    returns = np.full(n, n)
    same = ids[order[:-1]] == ids[order[1:]]
    returns[order[:-1][same]] = (order[1:] - order[:-1])[same]
    block, farthest = 1, returns
    while True:
        block *= 2
        pairs = len(farthest) // 2
        farthest = np.maximum(farthest[: 2 * pairs : 2], farthest[1 : 2 * pairs : 2])
        # A run of four periods from ``least`` to ``most`` holds a whole block and its return.
        least, most = -(-(2 * block - 1) // 3), (4 * block - 2) // 3
        if least * REPEATS > n:
            return sorted(runs, key=lambda r: (r[0], r[2]))
        starts = np.flatnonzero(farthest <= most) * block
        starts = starts[starts + block + least <= n]
        starts = starts[~_held(runs, starts, np.minimum(starts + block + most, n))]
        if len(starts):
            _extend(ids, block, *occurrences(ids, starts, block, least, most), runs)


def _extend(
    ids: np.ndarray, block: int, starts: np.ndarray, distances: np.ndarray, runs: list[tuple[int, int, int]]
) -> None:
    """Add the runs to which occurrences of blocks belong, shorter periods first."""
    order = np.lexsort((starts, distances))
    starts = starts[order]
    periods, first_of = np.unique(distances[order], return_index=True)
    for period, seeds in zip(periods.tolist(), np.split(starts, first_of[1:]), strict=False):
        # In a known run this period is a multiple of the run's.
        seeds = seeds[~_held(runs, seeds, seeds + block + period)]
        covered = 0
        for start in seeds.tolist():
            if start < covered or not np.array_equal(ids[start : start + block], ids[start + period : start + period + block]):
                continue
            covered = start + block + _agrees(ids, start + block, period, 1)
            first = start - _agrees(ids, start - 1, period, -1)
            length = covered - first + period
            if length >= max(SHORTEST, REPEATS * period) and not any(
                _agrees(ids[first : first + period + shorter], 0, shorter, 1) == period for shorter in _divisors(period)
            ):
                runs.append((first, length, period))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but for those that a run holds after its first period, joined by blanks."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join(compress(words, keep))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id``, ``runs``, an array by start and period of (start, length,
    period) in words, and ``collapsed``, the text with a single period of each run.

    Words are what stands between ASCII white space. A run is a longest stretch in which words
    a period apart are equal, of the shortest such period; it has six words and four periods
    at least. Runs may overlap. A null or empty text has no run and collapses to the empty
    text. A text of any length is one row, whose blocks are transformed some at a time.
    Repeated rows are searched each; an empty table gives an empty one. Other columns are
    not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([*rows.schema.fields[:1], *StructType.fromDDL(f"runs: {RUNS}, collapsed: string")])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found, texts = [], []
            for text in batch["text"].to_pylist():
                words = text.encode().split() if text else []
                number = defaultdict(count(1).__next__)
                runs = find_runs(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
                found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                texts.append(collapsed(words, runs).decode())
            yield {"id": batch["id"], "runs": found, "collapsed": texts}

    return in_arrow(rows, schema, work)


def digests(found: DataFrame) -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)."""

    def worse(x, y):
        longer = x["length"] * y["period"] - y["length"] * x["period"]
        return (
            F.when(longer != 0, -F.signum(longer.cast("double")))
            .when(x["start"] != y["start"], F.signum((x["start"] - y["start"]).cast("double")))
            .otherwise(F.signum((x["period"] - y["period"]).cast("double")))
            .cast("int")
        )

    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    best = found.withColumn("_best", F.get(F.array_sort("runs", worse), 0))
    return best.select(
        "id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.call_function("div", 1000 * F.col("_best.length"), F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
