"""Operators: DataFrames in, DataFrames out."""

from roadstream.operators.distinct import (
    area_vehicle_count,
    area_vehicle_count_bloom,
    area_vehicle_count_running,
    area_vehicle_sketches,
    vehicle_count_of_sketches,
)
from roadstream.operators.enrich import (
    overspeed,
    severe_overspeed,
    watchlist_passages,
    with_speed_limits,
)
from roadstream.operators.matching import police_interval_join, police_match
from roadstream.operators.parse import (
    classified,
    parse_passages,
    parse_police_actions,
    parse_violations,
    quality_split,
)
from roadstream.operators.patterns import dangerous_driving, dangerous_pairs
from roadstream.operators.repeats import repeat_plate, repeat_plate_daily
from roadstream.operators.track import car_track, lookup_track, track_rows
from roadstream.operators.windows import (
    average_speed,
    average_speed_2dp,
    rank_congested,
    top_congested,
    top_congested_report,
)

__all__ = [name for name in dir() if not name.startswith("_")]
