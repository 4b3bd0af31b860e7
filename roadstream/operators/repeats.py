"""Cloned plates: one car seen again too soon after an earlier passage.

Per car, the first passage is the anchor. A later passage less than the gap after the
anchor is a warning and keeps the anchor; any other passage becomes the new anchor.

Read in order this is a sequential fold. It is computed in four steps, none of which
gathers a car's history:

1. Passages with no other passage of the car within the gap cannot matter and go first,
   which leaves little of ordinary traffic. What stays is cut into blocks of time.
2. A block that begins within the gap of an earlier passage is open: its anchors depend
   on the anchor before it. Such a block is summarised as a step function from the time
   of that anchor to the time of the block's last anchor.
3. The step functions of neighbouring blocks are composed in groups, those of the groups in
   larger ones, and so on until no group depends on the one before it. Anchors are then
   handed down the same levels, so that no row or task holds more than one group.
4. With its incoming anchor known each block lists its anchors. Anchors of a car lie at
   least a gap apart, so a passage finds its own by an equality join on gap-wide bins.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream.constants import REPEAT_GAP_MS, REPEAT_MESSAGE
from roadstream.functions.anchors import compose_udf, entering_udf, steps_udf
from roadstream.functions.timing import floor_div, local_day
from roadstream.plans import cut_lineage, fold_copies, in_blocks, unfold_copies

_GAPS_PER_BLOCK = 64
#: Neighbouring blocks, or groups of them, whose step functions meet in one row.
FAN_OUT = 32
#: More than the number of blocks before 1970, and no boundary of large groups.
_FAR = 0x0555555555555555


def _anchors_in(points: Column, incoming: Column, gap_ms: int) -> Column:
    """The anchors among a block's (time, camera) points in order of time.

    ``incoming`` is the time of the anchor before them, null if there is none near.
    """
    far_past = F.lit(-(2**62)).cast("bigint")
    start = F.struct(
        F.coalesce(incoming, far_past).alias("time"),
        F.slice(points, 1, 0).alias("found"),
    )

    def step(state: Column, point: Column) -> Column:
        time = point["action_time"]
        moved = F.struct(
            time.alias("time"), F.array_append(state["found"], point).alias("found")
        )
        return F.when(time - state["time"] >= gap_ms, moved).otherwise(state)

    return F.aggregate(points, start, step, lambda state: state["found"])


def _crowded(passages: DataFrame, gap_ms: int) -> DataFrame:
    """Distinct passages that have another one of their car within the gap.

    ``_first`` marks the passage that would be the anchor among those of one time, and
    ``_opens`` those with no passage within the gap before them.
    """
    distinct = fold_copies(
        passages.select("car", "action_time", "camera_id"),
        "car",
        "action_time",
        "camera_id",
    )
    blocks = in_blocks(
        distinct,
        "action_time",
        _GAPS_PER_BLOCK * gap_ms,
        before_ms=gap_ms,
        after_ms=gap_ms,
    )
    order = Window.partitionBy("car", "_block").orderBy("action_time", "camera_id")
    since = F.col("action_time") - F.lag("action_time").over(order)
    until = F.lead("action_time").over(order) - F.col("action_time")
    near = blocks.withColumn("_since", since).withColumn("_until", until)
    return near.where(
        (F.col("_home") == F.col("_block"))
        & (
            (F.col("_since") < gap_ms)
            | (F.col("_until") < gap_ms)
            | (F.col("_copies") > 1)
        )
    ).select(
        "car",
        "_block",
        "action_time",
        "camera_id",
        "_copies",
        F.coalesce(F.col("_since") > 0, F.lit(True)).alias("_first"),
        F.coalesce(F.col("_since") >= gap_ms, F.lit(True)).alias("_opens"),
    )


def _blocks(crowded: DataFrame, gap_ms: int) -> DataFrame:
    """Per car and block its points and its step function; ``open`` if this depends on the
    anchor that enters the block."""
    blocks = (
        crowded.where("_first")
        .groupBy("car", "_block")
        .agg(
            F.array_sort(F.collect_list(F.struct("action_time", "camera_id"))).alias("_points"),
            # The block is open unless its earliest passage opens.
            (~F.min_by("_opens", "action_time")).alias("_open"),
        )
    )
    return blocks.withColumn("_steps", steps_udf(gap_ms)("_points.action_time", "_open"))


def _grouped(level: DataFrame, gap_ms: int, fan_out: int) -> DataFrame:
    """A level further up: groups of up to ``fan_out`` neighbouring blocks, or groups."""
    members = F.array_sort(F.collect_list(F.struct("_block", "_open", "_steps.upto", "_steps.last")))
    groups = (
        level.groupBy("car", floor_div(F.col("_block"), fan_out).alias("_group"))
        .agg(members.alias("_members"))
        .withColumnRenamed("_group", "_block")
        .withColumn("_open", F.get("_members", F.lit(0))["_open"])
    )
    return groups.withColumn("_steps", compose_udf(gap_ms)("_members.upto", "_members.last"))


def _entering(blocks: DataFrame, gap_ms: int, fan_out: int) -> DataFrame:
    """The anchor that enters each block: car, _block, _incoming.

    Open blocks follow their predecessor in number. Step functions are composed upward, level
    by level, until no group depends on the one before it; anchors are then handed down."""
    # Blocks are counted from far before all times: on both sides of zero, groups would never meet.
    levels, level = [], blocks.drop("_points").withColumn("_block", F.col("_block") + _FAR)
    while True:
        level = cut_lineage(_grouped(level, gap_ms, fan_out))
        levels.append(level)
        if not level.where("_open").limit(1).count():
            break
    incoming = None
    for level in reversed(levels):
        groups = level.withColumn("_incoming", F.lit(None).cast("bigint")) if incoming is None else level.join(incoming, ["car", "_block"], "left")
        entered = entering_udf(gap_ms)("_incoming", "_members.upto", "_members.last")
        each = groups.select("car", F.explode(F.arrays_zip("_members._block", entered.alias("_incoming"))).alias("_m"))
        incoming = each.select("car", F.col("_m._block").alias("_block"), F.col("_m._incoming").alias("_incoming"))
    return incoming.withColumn("_block", F.col("_block") - _FAR)


def _anchors(crowded: DataFrame, gap_ms: int, fan_out: int = FAN_OUT) -> DataFrame:
    """Time and camera of every anchor among the crowded passages."""
    blocks = cut_lineage(_blocks(crowded, gap_ms))
    incoming = _entering(blocks, gap_ms, fan_out)
    found = _anchors_in(F.col("_points"), F.col("_incoming"), gap_ms)
    return (
        blocks.join(incoming, ["car", "_block"], "left")
        .select("car", F.explode(found).alias("_found"))
        .select(
            "car",
            F.col("_found.action_time").alias("_anchor"),
            F.col("_found.camera_id").alias("_camera"),
        )
    )


def repeat_plate(passages: DataFrame, gap_ms: int = REPEAT_GAP_MS) -> DataFrame:
    """Warnings with the two cameras in the order of time, for a batch frame.

    Passages are taken in the order of time and camera. ``create_time`` is the time of
    the later passage. ``repeat_plate_stream`` is the form for streams.
    """
    crowded = cut_lineage(_crowded(passages, gap_ms))
    anchors = _anchors(crowded, gap_ms)
    bin_no = floor_div(F.col("_anchor"), gap_ms)
    anchors = anchors.withColumn("_bin", F.explode(F.array(bin_no, bin_no + 1)))
    rows = crowded.withColumn("_bin", floor_div(F.col("action_time"), gap_ms))
    since = F.col("action_time") - F.col("_anchor")
    hits = rows.join(anchors, ["car", "_bin"]).where((since >= 0) & (since < gap_ms))
    # One copy of the anchor is no repetition of itself.
    itself = (since == 0) & F.col("_first")
    counted = hits.withColumn("_copies", F.col("_copies") - itself.cast("int"))
    later = since > 0
    return unfold_copies(counted).select(
        "car",
        F.when(later, F.col("_camera")).otherwise(F.col("camera_id")).alias(
            "first_camera_id"
        ),
        F.when(later, F.col("camera_id")).otherwise(F.col("_camera")).alias(
            "second_camera_id"
        ),
        F.lit(REPEAT_MESSAGE).alias("msg"),
        F.col("action_time").alias("create_time"),
    )


def repeat_plate_daily(warnings: DataFrame, zone: str = "UTC") -> DataFrame:
    """The first warning of each car and calendar day."""
    rest = ["create_time", "first_camera_id", "second_camera_id", "msg"]
    first = warnings.groupBy("car", local_day(F.col("create_time"), zone).alias("day")).agg(
        F.min(F.struct(*rest)).alias("_first")
    )
    return first.select(
        "car",
        "day",
        *[f"_first.{c}" for c in ("first_camera_id", "second_camera_id", "msg")],
        "_first.create_time",
    )
