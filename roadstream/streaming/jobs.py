"""The traffic jobs on streams, from passages to a sink.

Operators without own state run inside each micro-batch, with the dimension read anew, so
a changed speed limit or violation list applies from the next batch on.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from roadstream import constants as C
from roadstream import schemas
from roadstream.operators import (
    area_vehicle_count_running,
    average_speed,
    average_speed_2dp,
    classified,
    overspeed,
    police_match,
    rank_congested,
    track_rows,
    watchlist_passages,
)
from roadstream.operators.parse import KINDS
from roadstream.streaming.counts import counts_sink
from roadstream.streaming.repeats import repeat_plate_stream
from roadstream.streaming.sinks import Sink, insert_if_absent, split_by_kind, start

Load = Callable[[], DataFrame]


def _per_batch(work: Callable[[DataFrame], DataFrame], sink: Sink) -> Sink:
    def run(batch: DataFrame, batch_id: int) -> None:
        sink(work(batch), batch_id)

    return run


def overspeed_job(
    passages: DataFrame, monitors: Load, sink: Sink, checkpoint: str, **trigger
) -> StreamingQuery:
    """Overspeed records against the monitors as they are at each batch."""
    work = _per_batch(lambda batch: overspeed(batch, monitors()), sink)
    return start(passages, work, checkpoint, **trigger)


def quality_job(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    schema: StructType = schemas.PASSAGE,
    report: Callable[[int, dict[str, int]], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """Good lines and rejected ones by reason, each kind in a table of its own, from one parse."""
    return start(classified(lines, schema), split_by_kind(path, KINDS, report), checkpoint, **trigger)


def track_job(
    passages: DataFrame, violation_list: Load, sink: Sink, checkpoint: str, **trigger
) -> StreamingQuery:
    """Trajectory rows of the cars on the list as it is at each batch."""
    work = _per_batch(
        lambda batch: track_rows(watchlist_passages(batch, violation_list())), sink
    )
    return start(passages, work, checkpoint, **trigger)


def average_speed_job(
    passages: DataFrame,
    sink: Sink,
    checkpoint: str,
    size_ms: int = C.AVERAGE_SIZE_MS,
    slide_ms: int = C.AVERAGE_SLIDE_MS,
    **trigger,
) -> StreamingQuery:
    """Average speeds of every window once it has closed."""
    return start(average_speed(passages, size_ms, slide_ms), sink, checkpoint, **trigger)


def congestion_job(
    passages: DataFrame,
    sink: Sink,
    checkpoint: str,
    k: int = C.TOP_K,
    size_ms: int = C.AVERAGE_SIZE_MS,
    slide_ms: int = C.TOP_SLIDE_MS,
    **trigger,
) -> StreamingQuery:
    """The most congested monitors of every window once it has closed.

    All averages of a window leave the state in the batch in which it closes, so ranking
    that batch ranks whole windows, with the same limited ranking as on batch frames.
    """
    averages = average_speed_2dp(passages, size_ms, slide_ms)
    work = _per_batch(lambda batch: rank_congested(batch, k), sink)
    return start(averages, work, checkpoint, **trigger)


def area_count_job(
    passages: DataFrame,
    sink: Sink,
    checkpoint: str,
    size_ms: int = C.AREA_WINDOW_MS,
    **trigger,
) -> StreamingQuery:
    """Running vehicle counts; the newest row per area and window is the valid one."""
    counts = area_vehicle_count_running(passages, size_ms)
    return start(counts, sink, checkpoint, mode="update", **trigger)


def running_count_job(
    passages: DataFrame,
    path: str,
    state: str,
    checkpoint: str,
    size_ms: int = C.AREA_WINDOW_MS,
    **trigger,
) -> StreamingQuery:
    """A running vehicle count for every passage, stored at ``path`` once the watermark has
    passed it; ``state`` is the folder of what is kept between batches."""
    return start(passages, counts_sink(path, state, size_ms), checkpoint, **trigger)


def repeat_plate_job(
    passages: DataFrame,
    path: str,
    checkpoint: str,
    gap_ms: int = C.REPEAT_GAP_MS,
    zone: str = "UTC",
    **trigger,
) -> StreamingQuery:
    """The first cloned-plate warning per car and day, stored at ``path``."""
    warnings = repeat_plate_stream(passages, gap_ms)
    return start(warnings, insert_if_absent(path, zone), checkpoint, **trigger)


def police_job(
    actions: DataFrame,
    violations: DataFrame,
    sink: Sink,
    checkpoint: str,
    tolerance_ms: int = C.MATCH_TOLERANCE_MS,
    **trigger,
) -> StreamingQuery:
    """Matched and left-over police actions and violations."""
    matches = police_match(actions, violations, tolerance_ms)
    return start(matches, sink, checkpoint, **trigger)
