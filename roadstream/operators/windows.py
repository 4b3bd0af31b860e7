"""Sliding averages per monitor and the most congested monitors."""

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream.constants import (
    AVERAGE_SIZE_MS,
    AVERAGE_SLIDE_MS,
    REPORT_HEAD,
    REPORT_LINE,
    TOP_K,
    TOP_SLIDE_MS,
    WATERMARK_DELAY,
)
from roadstream.functions.speed import mean_speed, mean_speed_2dp, speed_parts
from roadstream.functions.timing import floor_to, stamped


_PARTS = ("_units", "_rest", "_n_rest")


def _sums(parts, n: Column) -> list[Column]:
    named = zip(parts, _PARTS, strict=True)
    return [F.sum(part).alias(name) for part, name in named] + [F.sum(n).alias("car_count")]


def _stream_sums(
    passages: DataFrame, size_ms: int, slide_ms: int, delay: str
) -> DataFrame:
    """Sums per window in the state store; one emission per closed window."""
    window = F.window(
        "event_time", f"{size_ms} milliseconds", f"{slide_ms} milliseconds"
    )
    sums = (
        stamped(passages, "action_time", delay)
        .groupBy(window.alias("_window"), "monitor_id")
        .agg(*_sums(speed_parts(F.col("speed")), F.lit(1)))
    )
    start = F.unix_millis("_window.start")
    return sums.select(start.alias("start_time"), "monitor_id", *_PARTS, "car_count")


def _batch_sums(passages: DataFrame, size_ms: int, slide_ms: int) -> DataFrame:
    """Sums per window by way of disjoint panes.

    A passage is added to one pane instead of to every window that covers it; only the
    pane sums are then copied into their windows.
    """
    pane_ms = gcd(size_ms, slide_ms)
    panes = (
        passages.select(
            "monitor_id",
            floor_to(F.col("action_time"), pane_ms).alias("_pane"),
            *[p.alias(n) for p, n in zip(speed_parts(F.col("speed")), _PARTS, strict=True)],
        )
        .groupBy("monitor_id", "_pane")
        .agg(*_sums(map(F.col, _PARTS), F.lit(1)))
    )
    last_start = floor_to(F.col("_pane"), slide_ms)
    first_start = floor_to(F.col("_pane") - size_ms, slide_ms) + slide_ms
    starts = F.sequence(first_start, last_start, F.lit(slide_ms).cast("bigint"))
    # With a slide above the size a pane may lie between two windows.
    starts = F.when(first_start <= last_start, starts)
    return (
        panes.select("monitor_id", F.explode(starts).alias("start_time"), *_PARTS, "car_count")
        .groupBy("start_time", "monitor_id")
        .agg(*_sums(map(F.col, _PARTS), F.col("car_count")))
    )


def _averages(
    passages: DataFrame, size_ms: int, slide_ms: int, delay: str, mean
) -> DataFrame:
    if passages.isStreaming:
        sums = _stream_sums(passages, size_ms, slide_ms, delay)
    else:
        sums = _batch_sums(passages, size_ms, slide_ms)
    return sums.select(
        "start_time",
        (F.col("start_time") + size_ms).alias("end_time"),
        "monitor_id",
        mean(*map(F.col, _PARTS), F.col("car_count")).alias("avg_speed"),
        "car_count",
    )


def average_speed(
    passages: DataFrame,
    size_ms: int = AVERAGE_SIZE_MS,
    slide_ms: int = AVERAGE_SLIDE_MS,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """Average speed and number of passages per monitor and sliding window.

    Windows are [start, end) and aligned to the epoch.
    """
    return _averages(passages, size_ms, slide_ms, delay, mean_speed)


def average_speed_2dp(
    passages: DataFrame,
    size_ms: int = AVERAGE_SIZE_MS,
    slide_ms: int = TOP_SLIDE_MS,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """As ``average_speed``, with the average rounded to two decimals."""
    return _averages(passages, size_ms, slide_ms, delay, mean_speed_2dp)


def rank_congested(averages: DataFrame, k: int = TOP_K) -> DataFrame:
    """The ``k`` monitors with most passages in each window of a batch frame.

    Ties go to the lower monitor id. The rank limit is applied in every task before the
    rows of a window meet, so at most k rows per task and window are moved.
    """
    order = Window.partitionBy("start_time", "end_time").orderBy(
        F.desc("car_count"), "monitor_id"
    )
    return (
        averages.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(
            "start_time", "end_time", "rank", "monitor_id", "car_count", "avg_speed"
        )
    )


def top_congested(
    passages: DataFrame,
    k: int = TOP_K,
    size_ms: int = AVERAGE_SIZE_MS,
    slide_ms: int = TOP_SLIDE_MS,
) -> DataFrame:
    """The most congested monitors per sliding window of a batch frame.

    ``congestion_job`` runs the same ranking on the closed windows of a stream.
    """
    return rank_congested(average_speed_2dp(passages, size_ms, slide_ms), k)


def top_congested_report(ranked: DataFrame) -> DataFrame:
    """One text per window from the rows of ``rank_congested``."""
    line = F.format_string(REPORT_LINE, "monitor_id", "car_count", "avg_speed")
    head = F.format_string(REPORT_HEAD, "start_time", "end_time")
    lines = F.sort_array(F.collect_list(F.struct("rank", line.alias("line"))))
    return (
        ranked.groupBy("start_time", "end_time")
        .agg(lines.alias("_lines"))
        .select(
            "start_time",
            "end_time",
            F.concat(head, F.array_join("_lines.line", "")).alias("report"),
        )
    )
