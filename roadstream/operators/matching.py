"""Police actions against violations of the same car within a time tolerance."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.constants import MATCH_TOLERANCE_MS, NO_DELAY
from roadstream.functions.timing import span, stamped
from roadstream.plans import in_blocks


def _actions(actions: DataFrame, delay: str) -> DataFrame:
    return stamped(actions, "action_time", delay).select(
        "car",
        "police_id",
        "action_status",
        "action_time",
        F.col("event_time").alias("_action_at"),
    )


def _violations(violations: DataFrame, delay: str) -> DataFrame:
    return stamped(violations, "create_time", delay).select(
        F.col("car").alias("_violation_car"),
        "msg",
        "create_time",
        F.col("event_time").alias("_violation_at"),
    )


def _sides(actions, violations, tolerance_ms, wide):
    """Both sides in time blocks, the ``wide`` one also in the blocks it reaches.

    Rows within the tolerance then share a block exactly once, so car and block together
    are an equality key that spreads a hot car over time.
    """
    block_ms = max(4 * tolerance_ms, 1)
    reach = {"before_ms": tolerance_ms, "after_ms": tolerance_ms + 1}
    a_reach, v_reach = (reach, {}) if wide == "actions" else ({}, reach)
    a = in_blocks(actions, "action_time", block_ms, **a_reach).drop("_home")
    v = (
        in_blocks(violations, "create_time", block_ms, **v_reach)
        .drop("_home")
        .withColumnRenamed("_block", "_violation_block")
    )
    close = (
        (F.col("car") == F.col("_violation_car"))
        & (F.col("_block") == F.col("_violation_block"))
        & (F.col("_violation_at") >= F.col("_action_at") - span(tolerance_ms))
        & (F.col("_violation_at") <= F.col("_action_at") + span(tolerance_ms))
    )
    return a, v, close


_OUTPUT = ["car", "police_id", "action_status", "action_time", "msg", "create_time"]


def police_interval_join(
    actions: DataFrame,
    violations: DataFrame,
    tolerance_ms: int = MATCH_TOLERANCE_MS,
    delay: str = NO_DELAY,
) -> DataFrame:
    """All pairs of one car at most ``tolerance_ms`` apart, both bounds included."""
    a, v, close = _sides(
        _actions(actions, delay), _violations(violations, delay), tolerance_ms, "violations"
    )
    return a.join(v, close, "inner").select(*_OUTPUT)


def police_match(
    actions: DataFrame,
    violations: DataFrame,
    tolerance_ms: int = MATCH_TOLERANCE_MS,
    delay: str = NO_DELAY,
) -> DataFrame:
    """Pairs within the tolerance and, by ``kind``, the actions and violations left over.

    ``kind`` is matched, action_only or violation_only; the columns of an absent side are
    null. On streams a leftover row appears once the watermark has passed its tolerance.
    """
    acted, violated = _actions(actions, delay), _violations(violations, delay)
    a, v, close = _sides(acted, violated, tolerance_ms, "violations")
    paired = a.join(v, close, "left_outer")
    with_actions = paired.select(
        F.when(F.col("_violation_at").isNull(), "action_only")
        .otherwise("matched")
        .alias("kind"),
        *_OUTPUT,
    )

    a, v, close = _sides(acted, violated, tolerance_ms, "actions")
    if actions.isStreaming or violations.isStreaming:
        alone = v.join(a, close, "left_outer").where(F.col("_action_at").isNull())
    else:
        # Only whether an action exists matters, so copies of its time are dropped.
        times = a.select("car", "_block", "_action_at").distinct()
        alone = v.join(times, close, "left_anti")
    violation_only = alone.select(
        F.lit("violation_only").alias("kind"),
        F.col("_violation_car").alias("car"),
        *[F.lit(None).cast("string").alias(c) for c in ("police_id", "action_status")],
        F.lit(None).cast("bigint").alias("action_time"),
        "msg",
        "create_time",
    )
    return with_actions.unionByName(violation_only)
