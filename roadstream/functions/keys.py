"""Row keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadstream.constants import MAX_LONG


def track_key(car: Column, action_time: Column) -> Column:
    """Key of a trajectory row; within a car the newest row sorts first."""
    # A constant minuend of 19 digits keeps every key of one car equally long.
    reversed_time = (F.lit(MAX_LONG) - action_time).cast("string")
    return F.concat(F.lit("row_"), car, F.lit("_"), reversed_time)
