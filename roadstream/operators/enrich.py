"""Passages against the monitor and violation-list dimensions.

Every operator here leaves the passages where they are while the dimension fits a
broadcast, and runs unchanged on streaming passages. There the dimension is measured when
the query is built; the jobs in ``roadstream.streaming`` read and measure it per batch.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.constants import DEFAULT_SPEED_LIMIT, OVERSPEED_FACTOR, SEVERE_FACTOR
from roadstream.plans import join_dimension


def overspeed(
    passages: DataFrame, monitors: DataFrame, factor: float = OVERSPEED_FACTOR
) -> DataFrame:
    """Passages faster than the monitor's limit times ``factor``.

    Monitors without a positive limit, and passages of unknown monitors, give nothing.
    """
    limits = monitors.where(F.col("speed_limit") > 0).select("monitor_id", "speed_limit")
    joined = join_dimension(
        passages.select("car", "monitor_id", "road_id", "speed", "action_time"),
        limits,
        "monitor_id",
    )
    return joined.where(
        F.col("speed") > F.col("speed_limit") * F.lit(float(factor))
    ).select(
        "car",
        "monitor_id",
        "road_id",
        F.col("speed").alias("real_speed"),
        F.col("speed_limit").alias("limit_speed"),
        "action_time",
    )


def with_speed_limits(
    passages: DataFrame, monitors: DataFrame, default_limit: int = DEFAULT_SPEED_LIMIT
) -> DataFrame:
    """Every passage with its limit: the monitor's, or ``default_limit`` if unknown.

    The road is the monitor's where the monitor is known. A limit of 0 is kept.
    """
    known = monitors.select(
        "monitor_id",
        F.col("speed_limit").alias("_limit"),
        F.col("road_id").alias("_road"),
    )
    joined = join_dimension(
        passages.select("car", "monitor_id", "road_id", "speed", "action_time"),
        known,
        "monitor_id",
        "left",
    )
    return joined.select(
        "car",
        "monitor_id",
        F.coalesce("_road", "road_id").alias("road_id"),
        F.col("speed").alias("real_speed"),
        F.coalesce("_limit", F.lit(default_limit)).alias("limit_speed"),
        "action_time",
    )


def severe_overspeed(
    passages: DataFrame,
    monitors: DataFrame,
    factor: float = SEVERE_FACTOR,
    default_limit: int = DEFAULT_SPEED_LIMIT,
) -> DataFrame:
    """Passages above their limit times ``factor``, unknown monitors included."""
    limited = with_speed_limits(passages, monitors, default_limit)
    return limited.where(
        F.col("limit_speed") * F.lit(float(factor)) < F.col("real_speed")
    )


def watchlist_passages(passages: DataFrame, violation_list: DataFrame) -> DataFrame:
    """Passages of cars that are on the violation list."""
    cars = violation_list.select("car")
    return join_dimension(passages, cars, "car", "left_semi").select(*passages.columns)
