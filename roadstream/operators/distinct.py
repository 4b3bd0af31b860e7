"""Distinct vehicles per area and tumbling window."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadstream.constants import AREA_WINDOW_MS, WATERMARK_DELAY
from roadstream.functions.timing import floor_to, stamped
from roadstream.plans import fold_copies, unfold_copies

_SLICES = 100
#: Sketches of 4,096 registers: a standard error of 1.04 / 64, that is 1.63 %.
SKETCH_LG_K, SKETCH_RSD = 12, 0.0163


def _stream_windows(passages: DataFrame, size_ms: int, delay: str) -> DataFrame:
    return stamped(passages, "action_time", delay).select(
        F.window("event_time", f"{size_ms} milliseconds").alias("_window"),
        "area_id",
        "car",
    )


def _with_bounds(counts: DataFrame, size_ms: int) -> DataFrame:
    start = (
        F.unix_millis("_window.start")
        if "_window" in counts.columns
        else F.col("start_time")
    )
    return counts.select(
        "area_id",
        start.alias("start_time"),
        (start + size_ms).alias("end_time"),
        "car_count",
    )


def _batch_windows(passages: DataFrame, size_ms: int) -> DataFrame:
    start = floor_to(F.col("action_time"), size_ms)
    return passages.withColumn("start_time", start)


def area_vehicle_count(
    passages: DataFrame, size_ms: int = AREA_WINDOW_MS, delay: str = WATERMARK_DELAY
) -> DataFrame:
    """Exact number of distinct cars per area and window."""
    if passages.isStreaming:
        seen = _stream_windows(passages, size_ms, delay).dropDuplicates(
            ["_window", "area_id", "car"]
        )
        counts = seen.groupBy("_window", "area_id").agg(
            F.count(F.lit(1)).alias("car_count")
        )
    else:
        # Planned as a distinct over (window, area, car) and then partial counts, so no
        # task holds an area's cars.
        counts = (
            _batch_windows(passages, size_ms)
            .groupBy("area_id", "start_time")
            .agg(F.count_distinct("car").alias("car_count"))
        )
    return _with_bounds(counts, size_ms)


def area_vehicle_count_bloom(
    passages: DataFrame,
    size_ms: int = AREA_WINDOW_MS,
    delay: str = WATERMARK_DELAY,
    rsd: float = 0.02,
) -> DataFrame:
    """Approximate number of distinct cars in bounded memory per area and window."""
    count = F.approx_count_distinct("car", rsd).alias("car_count")
    if passages.isStreaming:
        windows = _stream_windows(passages, size_ms, delay)
        counts = windows.groupBy("_window", "area_id").agg(count)
    else:
        windows = _batch_windows(passages, size_ms)
        counts = windows.groupBy("area_id", "start_time").agg(count)
    return _with_bounds(counts, size_ms)


def area_vehicle_sketches(
    passages: DataFrame,
    pane_ms: int = AREA_WINDOW_MS,
    delay: str = WATERMARK_DELAY,
    lg_k: int = SKETCH_LG_K,
) -> DataFrame:
    """Per area and pane of time a sketch of its cars, to be stored: sketches are united later
    into any windows, days or sets of areas without the passages.

    A sketch is ``2 ** lg_k`` bytes at most. Null cars are not counted."""
    sketch = F.hll_sketch_agg("car", F.lit(lg_k)).alias("sketch")
    if passages.isStreaming:
        panes = _stream_windows(passages, pane_ms, delay).groupBy("_window", "area_id").agg(sketch)
        start = F.unix_millis("_window.start")
    else:
        panes = _batch_windows(passages, pane_ms).groupBy("area_id", "start_time").agg(sketch)
        start = F.col("start_time")
    return panes.select("area_id", start.alias("start_time"), (start + pane_ms).alias("end_time"), "sketch")


def vehicle_count_of_sketches(
    sketches: DataFrame, size_ms: int, slide_ms: int | None = None, by: tuple[str, ...] = ("area_id",)
) -> DataFrame:
    """Approximate number of distinct cars in sliding windows, from stored pane sketches.

    Windows begin at multiples of ``slide_ms`` (by default tumbling ones of ``size_ms``); panes
    must divide both, as a pane that reaches over a window's end would be counted as a whole.
    ``by`` names the columns that counts are kept apart by: none for all areas together."""
    slide_ms = slide_ms or size_ms
    last = floor_to(F.col("start_time"), slide_ms)
    first = floor_to(F.col("start_time") - size_ms, slide_ms) + slide_ms
    placed = sketches.withColumn("_window", F.explode(F.sequence(first, last, F.lit(slide_ms).cast("bigint"))))
    united = placed.groupBy(*by, "_window").agg(F.hll_union_agg("sketch").alias("sketch"))
    return united.select(
        *by,
        F.col("_window").alias("start_time"),
        (F.col("_window") + size_ms).alias("end_time"),
        F.hll_sketch_estimate("sketch").alias("car_count"),
    )


def area_vehicle_count_running(
    passages: DataFrame,
    size_ms: int = AREA_WINDOW_MS,
    slice_ms: int | None = None,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """Distinct cars so far in the area's window, one row for every passage.

    Passages of a window count in the order of time, car and camera. A streaming frame
    gives the windowed counts instead, to be written in ``update`` output mode;
    ``running_count_job`` gives a row for every passage of a stream.

    The running sum is split into slices of a window: each slice starts from a row that
    carries the number of cars first seen in earlier slices, so a busy area's window is
    ordered in as many tasks as it has slices: a hundred, or as ``slice_ms`` says.
    """
    if passages.isStreaming:
        windows = _stream_windows(passages, size_ms, delay)
        seen = windows.dropDuplicates(["_window", "area_id", "car"])
        counts = seen.groupBy("_window", "area_id").agg(
            F.count(F.lit(1)).alias("car_count")
        )
        return _with_bounds(counts, size_ms)

    start = floor_to(F.col("action_time"), size_ms)
    # A plain minimum, so that the aggregation hashes; without a camera a car's entry
    # sorts ahead of all its passages of that time.
    firsts = passages.groupBy("area_id", start.alias("start_time"), "car").agg(
        F.min("action_time").alias("action_time")
    )
    return running_counts(passages, firsts, None, size_ms, slice_ms)


def running_counts(
    passages: DataFrame,
    firsts: DataFrame,
    before: DataFrame | None,
    size_ms: int,
    slice_ms: int | None = None,
) -> DataFrame:
    """The count at every passage, given the first passage of every car that is new in its
    area's window, and the counts (area_id, start_time, car_count) that windows begin with."""
    slice_ms = slice_ms or max(1, size_ms // _SLICES)
    start = floor_to(F.col("action_time"), size_ms)
    group = ["area_id", "start_time", "_slice"]

    def placed(df: DataFrame) -> DataFrame:
        # A slice never reaches into the next window.
        offset = F.col("action_time") - start
        return df.withColumn("start_time", start).withColumn(
            "_slice", floor_to(offset, slice_ms)
        )

    rows = placed(
        fold_copies(
            passages.select("area_id", "action_time", "car", "camera_id"),
            "area_id",
            "action_time",
            "car",
            "camera_id",
        )
    )
    firsts = placed(firsts.select("area_id", "car", "action_time"))
    earlier = (
        Window.partitionBy("area_id", "start_time")
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # How many cars each slice adds; a window has a fixed number of slices.
    slices = placed(passages.select("area_id", "action_time"))
    added = (
        slices.select(*group, F.lit(0).cast("bigint").alias("_new"))
        .unionByName(firsts.select(*group, F.lit(1).cast("bigint").alias("_new")))
        .groupBy(*group)
        .agg(F.sum("_new").alias("_new"))
    )
    carried = added.withColumn("_new", F.sum("_new").over(earlier) - F.col("_new"))
    if before is not None:
        same = [F.col(f"c.{c}").eqNullSafe(F.col(f"b.{c}")) for c in group[:2]]
        begun = F.col("_new") + F.coalesce(F.col("b.car_count"), F.lit(0))
        carried = carried.alias("c").join(before.alias("b"), same, "left").select(
            *[f"c.{c}" for c in group], begun.alias("_new")
        )

    def entries(df: DataFrame, kind: int, new) -> DataFrame:
        def column(name: str, kind_: str):
            source = F.col(name) if name in df.columns else F.lit(None)
            return source.cast(kind_).alias(name)

        return df.select(
            *group,
            column("action_time", "bigint"),
            column("car", "string"),
            column("camera_id", "string"),
            F.lit(kind).alias("_kind"),
            new.cast("bigint").alias("_new"),
            column("_copies", "bigint"),
        )

    # In a slice: the carried number, then each car's entry ahead of its passages. What
    # an entry lacks is null and sorts first.
    everything = (
        entries(carried, 0, F.col("_new"))
        .unionByName(entries(firsts, 1, F.lit(1)))
        .unionByName(entries(rows, 2, F.lit(0)))
    )
    running = (
        Window.partitionBy(*group)
        .orderBy("action_time", "car", "camera_id", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = everything.withColumn("car_count", F.sum("_new").over(running)).where(
        F.col("_kind") == 2
    )
    return unfold_copies(counted).select(
        "area_id",
        "start_time",
        (F.col("start_time") + size_ms).alias("end_time"),
        "action_time",
        "car",
        "camera_id",
        "car_count",
    )
