"""Cloned plates on a stream."""

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from roadstream.constants import REPEAT_GAP_MS, REPEAT_MESSAGE, WATERMARK_DELAY
from roadstream.functions.anchors import fold_anchor
from roadstream.streaming.ordered import in_time_order

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OUTPUT = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("car", "first_camera_id", "second_camera_id", "msg")]
    + [T.StructField("create_time", T.LongType())]
)
_ANCHOR = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("camera", T.StringType())])


def repeat_plate_stream(
    passages: DataFrame,
    gap_ms: int = REPEAT_GAP_MS,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """Warnings from a stream of passages, the same as ``repeat_plate`` gives for a batch.

    Passages wait until the watermark has passed them and are then taken in the order of time
    and camera, so that warnings do not depend on the order in which passages arrive
    within ``delay``. The state of a car is its waiting passages and one anchor, which is
    dropped once the watermark is a gap past it. Warnings later than the last watermark have
    not been given yet.
    """
    rows = passages.select("car", "action_time", "camera_id")
    return in_time_order(rows, ["car"], ["camera_id"], _ANCHOR, _OUTPUT, _warnings(gap_ms, REPEAT_MESSAGE), delay)


def _warnings(gap_ms: int, message: str):
    def fold(key: tuple, rows: list[tuple], held: dict | None):
        times = np.array([time for time, _ in rows], np.int64)
        # One place more, for the stored anchor at position -1.
        before = held or {"anchor": None, "camera": None}
        cameras = [*(camera for _, camera in rows), before["camera"]]
        anchors = [*times.tolist(), before["anchor"] or 0]
        hits, owners, at = fold_anchor(times, before["anchor"], gap_ms)
        out = []
        for hit, owner in zip(hits.tolist(), owners.tolist(), strict=True):
            pair = cameras[owner], cameras[hit]
            pair = pair if anchors[hit] > anchors[owner] else pair[::-1]
            out.append((key[0], *pair, message, anchors[hit]))
        return out, {"anchor": anchors[at], "camera": cameras[at]}, anchors[at] + gap_ms - 1

    return fold
