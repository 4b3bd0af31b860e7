"""The array helpers behind the cloned-plate operator, on the times of one block."""

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

# The functions travel to the executors with the plan; the package need not be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Above every sum of a time and a gap.
EVERY = 2**62

STEPS = "struct<upto array<bigint>, last array<bigint>>"


def anchor_steps(times: np.ndarray, gap_ms: int) -> tuple[np.ndarray, np.ndarray]:
    """Step function of a block with sorted distinct passage ``times``.

    For an incoming anchor a, the first passage at a + gap or later becomes the next
    anchor; the smallest ``upto`` >= a + gap has the block's last anchor beside it. Above
    the largest ``upto`` no passage qualifies and a itself stays the anchor.
    """
    n = len(times)
    following = np.searchsorted(times, times + gap_ms)
    last = np.where(following < n, following, np.arange(n))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    # An incoming anchor lies before the first passage.
    reach = min(n, int(np.searchsorted(times, times[0] + gap_ms)) + 1)
    upto, result = times[:reach], times[last[:reach]]
    ends = np.append(result[1:] != result[:-1], True)
    return upto[ends], result[ends]


def leave(upto: np.ndarray, last: np.ndarray, anchor: int, gap_ms: int) -> int:
    """The anchor that leaves a stretch of blocks which ``anchor`` enters."""
    at = int(np.searchsorted(upto, anchor + gap_ms))
    return int(last[at]) if at < len(upto) else anchor


def compose(
    first: tuple[np.ndarray, np.ndarray], then: tuple[np.ndarray, np.ndarray], gap_ms: int
) -> tuple[np.ndarray, np.ndarray]:
    """The step function of two neighbouring stretches. An anchor that passes through the first
    one unchanged meets the steps of the second."""
    (upto, last), (upto2, last2) = first, then
    at = np.searchsorted(upto2, last + gap_ms)
    mapped = np.where(at < len(upto2), last2[np.minimum(at, len(upto2) - 1)], last)
    through = upto2 > upto[-1]
    upto, mapped = np.append(upto, upto2[through]), np.append(mapped, last2[through])
    ends = np.append(mapped[1:] != mapped[:-1], True)
    return upto[ends], mapped[ends]


def steps_udf(gap_ms: int):
    @F.pandas_udf(STEPS)
    def steps(times: pd.Series, is_open: pd.Series) -> pd.DataFrame:
        pairs = []
        for t, depends in zip(times, is_open):
            times_ = np.asarray(t, dtype=np.int64)
            upto, last = anchor_steps(times_, gap_ms)
            # A closed block leaves the same anchor whatever enters it.
            pairs.append((upto, last) if depends else (np.array([EVERY]), last[:1]))
        return pd.DataFrame({"upto": [u for u, _ in pairs], "last": [v for _, v in pairs]})

    return steps


def _functions(uptos, lasts) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.asarray(u, np.int64), np.asarray(v, np.int64)) for u, v in zip(uptos, lasts)]


def compose_udf(gap_ms: int):
    """The step function of a group of neighbours, given in order."""

    @F.pandas_udf(STEPS)
    def composed(uptos: pd.Series, lasts: pd.Series) -> pd.DataFrame:
        out = []
        for u, v in zip(uptos, lasts):
            functions = _functions(u, v)
            whole = functions[0]
            for following in functions[1:]:
                whole = compose(whole, following, gap_ms)
            out.append(whole)
        return pd.DataFrame({"upto": [u for u, _ in out], "last": [v for _, v in out]})

    return composed


def entering_udf(gap_ms: int):
    """The anchor that enters each member of a group, from the one that enters the group."""

    @F.pandas_udf("array<bigint>")
    def entering(anchors: pd.Series, uptos: pd.Series, lasts: pd.Series) -> pd.Series:
        out = []
        for anchor, u, v in zip(anchors, uptos, lasts):
            # Without one: so early that it matters to no passage.
            anchor, entered = -EVERY if pd.isna(anchor) else int(anchor), []
            for upto, last in _functions(u, v):
                entered.append(anchor)
                anchor = leave(upto, last, anchor, gap_ms)
            out.append(entered)
        return pd.Series(out)

    return entering


def fold_anchor(
    times: np.ndarray, anchor: int | None, gap_ms: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """Follow the anchor through sorted ``times``.

    Returns the positions of the warnings, the position of each one's anchor (-1 for the
    given ``anchor``) and the position of the last anchor (-1 likewise). An anchor may be
    later than the first passages: the distance counts in both directions.
    """
    hits, owners = [], []
    at, i, n = -1, 0, len(times)
    if anchor is None:
        at, anchor, i = 0, int(times[0]), 1
    while i < n:
        if abs(int(times[i]) - anchor) < gap_ms:
            end = int(np.searchsorted(times, anchor + gap_ms))
            hits.append(np.arange(i, end))
            owners.append(np.full(end - i, at))
            i = end
        else:
            at, anchor = i, int(times[i])
            i += 1
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *hits]), np.concatenate([none, *owners]), at
