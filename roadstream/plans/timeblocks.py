"""Splitting one car's history into blocks of time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.functions.timing import floor_div


def in_blocks(
    df: DataFrame,
    time_col: str,
    block_ms: int,
    before_ms: int = 0,
    after_ms: int = 0,
) -> DataFrame:
    """Add ``_block`` (the block a row is processed in) and ``_home`` (its own block).

    A row is copied into the next block when it lies at most ``before_ms`` before that
    block begins, and into the previous one when it lies less than ``after_ms`` after
    that block ended. With the margins at least as wide as an operator looks back and
    ahead, every home row sees the same neighbours as in the unsplit history, while a
    hot car is spread over as many tasks as it has blocks.
    """
    time = F.col(time_col)
    first = floor_div(time - after_ms, block_ms)
    last = floor_div(time + before_ms, block_ms)
    home = df.withColumn("_home", floor_div(time, block_ms))
    if before_ms == 0 and after_ms == 0:
        return home.withColumn("_block", F.col("_home"))
    return home.withColumn("_block", F.explode(F.sequence(first, last)))
