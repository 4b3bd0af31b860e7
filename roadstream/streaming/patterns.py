"""Dangerous driving on a stream."""

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadstream.constants import (
    DANGER_EVENT,
    DANGER_HEAD,
    DEFAULT_SPEED_LIMIT,
    PATTERN_SPAN_MS,
    SEVERE_FACTOR,
    WATERMARK_DELAY,
)
from roadstream.operators.enrich import severe_overspeed
from roadstream.streaming.ordered import in_time_order

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EVENT = ["car", "monitor_id", "road_id", "real_speed", "limit_speed", "action_time"]
_ORDER = ["monitor_id", "road_id", "real_speed", "limit_speed"]
_RECENT = T.StructType(
    [
        T.StructField("times", T.ArrayType(T.LongType())),
        T.StructField("speeds", T.ArrayType(T.DoubleType())),
        T.StructField("limits", T.ArrayType(T.DoubleType())),
        T.StructField("texts", T.ArrayType(T.StringType())),
    ]
)
_OUTPUT = T.StructType(
    [
        T.StructField("car", T.StringType()),
        T.StructField("msg", T.StringType()),
        T.StructField("create_time", T.LongType()),
        T.StructField("real_speed", T.DoubleType()),
        T.StructField("limit_speed", T.DoubleType()),
        T.StructField("n_events", T.IntegerType()),
    ]
)


def dangerous_driving_stream(
    passages: DataFrame,
    monitors: DataFrame,
    span_ms: int = PATTERN_SPAN_MS,
    factor: float = SEVERE_FACTOR,
    default_limit: int = DEFAULT_SPEED_LIMIT,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """Every run of severe passages, with its text, as ``dangerous_driving`` gives for a batch.

    A run is given out once the watermark has passed its last passage. The state of a car is
    its severe passages of one span and of the watermark's delay; it expires a span after the
    last one. Runs that end later than the last watermark have not been given yet.
    """
    severe = severe_overspeed(passages, monitors, factor, default_limit)
    rows = severe.select(
        *_EVENT[:4],
        F.col("limit_speed").cast("double").alias("limit_speed"),
        "action_time",
        F.format_string(DANGER_EVENT, *_EVENT).alias("text"),
    )
    return in_time_order(rows, ["car"], _ORDER, _RECENT, _OUTPUT, _runs(span_ms, DANGER_HEAD), delay)


def _runs(span_ms: int, head: str):
    names = ["times", "speeds", "limits", "texts"]

    def fold(key: tuple, rows: list[tuple], held: dict | None):
        recent = list(zip(*[held[n] for n in names], strict=True)) if held else []
        out = []
        for _, _, speed, limit, time, event in rows:
            recent = [r for r in recent if time - r[0] < span_ms]
            recent.append((time, speed, limit, event))
            text = event
            # From the shortest run that ends here to the longest.
            for first in range(len(recent) - 2, -1, -1):
                begun, speed, limit, begins = recent[first]
                text = begins + text
                out.append((key[0], head % key[0] + text, begun, speed, limit, len(recent) - first))
        memory = {n: list(column) for n, column in zip(names, zip(*recent, strict=True), strict=True)}
        return out, memory, recent[-1][0] + span_ms - 1

    return fold
