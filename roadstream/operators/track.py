"""Trajectories of watched cars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.functions.keys import track_key


def track_rows(watched: DataFrame) -> DataFrame:
    """Passages as trajectory rows under a key that sorts a car's newest row first."""
    return watched.select(
        track_key(F.col("car"), F.col("action_time")).alias("row_key"),
        "car",
        "action_time",
        "monitor_id",
        "road_id",
        "speed",
    )


def lookup_track(tracks: DataFrame, row_key: str) -> DataFrame:
    """The row stored under one key; the equality reaches the table scan."""
    return tracks.where(F.col("row_key") == row_key)


def car_track(tracks: DataFrame, car: str) -> DataFrame:
    """One car's trajectory, newest first."""
    return tracks.where(F.col("car") == car).orderBy(F.desc("action_time"))
