"""Exact copies of a row are counted before a shuffle and restored at the end."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CHUNK = 1_000_000


def fold_copies(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows of ``columns`` with their multiplicity in ``_copies``."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))


def unfold_copies(df: DataFrame, count_col: str = "_copies") -> DataFrame:
    """Repeat each row ``count_col`` times (none for 0) and drop the count.

    Large counts unfold in two steps, so no array grows with the multiplicity.
    """
    n = F.col(count_col)
    last_chunk = F.call_function("div", n - 1, F.lit(_CHUNK))
    chunks = df.where(n > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk))
    )
    left = F.least(n - F.col("_chunk") * _CHUNK, F.lit(_CHUNK))
    return chunks.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(1).cast("bigint"), left))
    ).drop("_chunk", count_col)
