"""Dangerous driving: repeated severe overspeed of one car in a short time."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadstream.constants import (
    DANGER_EVENT,
    DANGER_HEAD,
    DEFAULT_SPEED_LIMIT,
    PATTERN_SPAN_MS,
    SEVERE_FACTOR,
    WATERMARK_DELAY,
)
from roadstream.functions.timing import span, stamped
from roadstream.operators.enrich import severe_overspeed
from roadstream.plans import in_blocks

_EVENT = ["car", "monitor_id", "road_id", "real_speed", "limit_speed", "action_time"]
_SPANS_PER_BLOCK = 16


def dangerous_driving(
    passages: DataFrame,
    monitors: DataFrame,
    span_ms: int = PATTERN_SPAN_MS,
    factor: float = SEVERE_FACTOR,
    default_limit: int = DEFAULT_SPEED_LIMIT,
) -> DataFrame:
    """Every run of two or more severe passages of a car that spans less than ``span_ms``.

    A run starts at any severe passage and ends at any later one within the span; the
    passages between belong to it. Time, speed and limit are those of the first passage,
    and ``msg`` lists all of them. Batch only; see ``dangerous_pairs`` for streams.

    Severe passages are first split into blocks of time, each with the passages that
    follow it within the span, so that a hot car's history is not gathered in one task.
    """
    severe = severe_overspeed(passages, monitors, factor, default_limit)
    blocks = in_blocks(
        severe, "action_time", _SPANS_PER_BLOCK * span_ms, after_ms=span_ms
    )
    in_block = Window.partitionBy("car", "_block")
    order = in_block.orderBy(*_EVENT[5:], *_EVENT[1:5])
    ahead = in_block.orderBy("action_time").rangeBetween(0, span_ms - 1)
    numbered = blocks.withColumn("_no", F.row_number().over(order)).withColumn(
        "_text", F.format_string(DANGER_EVENT, *_EVENT)
    )
    following = numbered.withColumn(
        # A window ordered by time alone gives equal times in any order.
        "_near", F.sort_array(F.collect_list(F.struct("_no", "_text")).over(ahead))
    ).where(F.col("_home") == F.col("_block"))
    # Passages at the same time are near each other; only later numbers follow.
    texts = F.transform(
        F.filter("_near", lambda near: near["_no"] > F.col("_no")),
        lambda near: near["_text"],
    )
    ends = following.withColumn("_later", texts).where(F.size("_later") > 0)
    runs = ends.withColumn(
        "_end", F.explode(F.sequence(F.lit(1), F.size("_later")))
    )
    return runs.select(
        "car",
        F.concat(
            F.format_string(DANGER_HEAD, "car"),
            F.col("_text"),
            F.array_join(F.slice("_later", F.lit(1), F.col("_end")), ""),
        ).alias("msg"),
        F.col("action_time").alias("create_time"),
        "real_speed",
        F.col("limit_speed").cast("double").alias("limit_speed"),
        (F.col("_end") + 1).alias("n_events"),
    )


def dangerous_pairs(
    severe: DataFrame, span_ms: int = PATTERN_SPAN_MS, delay: str = WATERMARK_DELAY
) -> DataFrame:
    """First and last passage of every run, from a stream of severe passages.

    A self join on the watermark keeps only one span of passages in state. Passages of a
    car are taken in the order of time, monitor and road; the passages between the two
    ends, and so the text, are left to the batch operator. Passages that are equal in all
    columns, or differ in their camera alone, do not pair with each other. Every pair
    within the span is a row, so the output grows with the number of runs.
    """
    block_ms = _SPANS_PER_BLOCK * span_ms
    first = in_blocks(stamped(severe, "action_time", delay), "action_time", block_ms)
    reached = in_blocks(
        stamped(severe, "action_time", delay), "action_time", block_ms, after_ms=span_ms
    )
    last = reached.select(
        *[F.col(c).alias(f"last_{c}") for c in (*_EVENT, "event_time", "_block")]
    )

    def place(prefix: str):
        return F.struct(
            *[F.col(prefix + c).alias(c) for c in ("action_time", *_EVENT[1:5])]
        )

    within = (
        (F.col("car") == F.col("last_car"))
        & (F.col("_block") == F.col("last__block"))
        & (F.col("last_event_time") >= F.col("event_time"))
        & (F.col("last_event_time") < F.col("event_time") + span(span_ms))
        & (place("last_") > place(""))
    )
    return first.join(last, within).select(
        "car",
        F.col("action_time").alias("create_time"),
        "real_speed",
        F.col("limit_speed").cast("double").alias("limit_speed"),
        F.col("last_action_time").alias("last_time"),
    )
