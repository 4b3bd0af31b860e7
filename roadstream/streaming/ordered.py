"""Keyed state over a stream whose rows are taken strictly in the order of time.

Rows wait in the state of their key until the watermark has passed them. Then no earlier one
can come any more, and what waits is handed on in order: the same rows give the same result,
whatever micro-batches they arrive in.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadstream.functions.timing import stamped

# The functions travel to the executors with the plan; the package need not be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Takes the key, the settled rows in order as tuples and the memory of the key (None at first);
#: returns the rows to give out, the memory and the time up to which it matters (None: forget it).
Fold = Callable[[tuple, list[tuple], dict | None], tuple[list[tuple], dict | None, int | None]]

_TIME = "action_time"


def in_time_order(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    memory: T.StructType,
    output: T.StructType,
    fold: Fold,
    delay: str,
) -> DataFrame:
    """The rows that ``fold`` gives for every key of the stream ``rows``.

    ``rows`` has its time in ``action_time``; rows of one time are taken by ``order``, rows
    without a time are left out. The memory of a key is kept until the watermark has passed the time ``fold`` names. A key's
    state holds its memory and the rows of one watermark delay.
    """
    names = [c for c in rows.columns if c not in keys]
    waiting = [T.StructField(f"waiting_{f.name}", T.ArrayType(f.dataType)) for f in rows.schema if f.name in names]
    state = T.StructType([*memory.fields, T.StructField("until", T.LongType()), *waiting])
    return (
        stamped(rows.where(F.col(_TIME).isNotNull()), _TIME, delay)
        .groupBy(*keys)
        .applyInPandasWithState(
            _settling(names, order, memory.names, output.names, fold),
            output,
            state,
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )


def _settling(names: list[str], order: list[str], memory: list[str], output: list[str], fold: Fold):
    time, *ties = (names.index(c) for c in (_TIME, *order))

    def place(row: tuple) -> tuple:
        # Nulls first and NaN last, as Spark sorts them.
        return row[time], [(0 if row[i] is None else 1 + (row[i] != row[i]), row[i]) for i in ties]

    def settle(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, until, rows = None, None, []
        if state.exists:
            stored = state.get
            until = stored[len(memory)]
            held = dict(zip(memory, stored, strict=False)) if until is not None else None
            rows += zip(*stored[len(memory) + 1 :], strict=True)
        if not state.hasTimedOut:
            for frame in frames:
                # Keys are small as a rule: plain tuples cost less than a frame for each.
                rows += zip(*[frame[c].tolist() for c in names], strict=True)
        mark = state.getCurrentWatermarkMs()
        # Zero stands for no watermark yet.
        ready = sorted([r for r in rows if r[time] <= mark and mark], key=place)
        rest = [r for r in rows if r[time] > mark or not mark]
        out: list[tuple] = []
        if ready:
            out, held, until = fold(key, ready, held)
        if until is not None and until <= mark:
            held, until = None, None
        due = min([*(r[time] for r in rest), *([until] if until is not None else [])], default=None)
        if due is not None:
            mine = [held[m] for m in memory] if held is not None else [None] * len(memory)
            waiting = [list(c) for c in zip(*rest, strict=True)] or [[] for _ in names]
            state.update((*mine, until, *waiting))
            state.setTimeoutTimestamp(max(int(due), mark + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=output)

    return settle
