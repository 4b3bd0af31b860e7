"""Column expressions over epoch-millisecond times."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.constants import DAY_MS


def floor_div(value: Column, step: int) -> Column:
    """Integer quotient rounded down, also below zero."""
    return F.call_function("div", value - F.pmod(value, F.lit(step)), F.lit(step))


def floor_to(value: Column, step: int) -> Column:
    """Largest multiple of ``step`` not above ``value``."""
    return value - F.pmod(value, F.lit(step))


def local_day(millis: Column, zone: str = "UTC") -> Column:
    """Calendar day of an instant in ``zone``, whatever the session time zone."""
    shifted = F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(millis), zone))
    return F.date_from_unix_date(floor_div(shifted, DAY_MS).cast("int"))


def stamped(df: DataFrame, time_col: str, delay: str) -> DataFrame:
    """Add ``event_time`` and its watermark (which batch frames ignore)."""
    return df.withColumn("event_time", F.timestamp_millis(time_col)).withWatermark(
        "event_time", delay
    )


def span(millis: int) -> Column:
    """A literal interval."""
    return F.expr(f"INTERVAL {int(millis)} MILLISECONDS")
