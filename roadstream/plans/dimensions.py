"""Joining passages with a dimension table (monitors, cars under watch)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
_ROW_OVERHEAD = 32
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(_ROW_OVERHEAD).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + 8 + F.coalesce(F.octet_length(field.name), F.lit(0))
        else:
            size = size + 16
    return size


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` on the executors; only one number reaches the driver."""
    if any(isinstance(f.dataType, _NESTED) for f in df.schema.fields):
        return False
    total = df.agg(F.sum(_row_bytes(df)).alias("bytes")).first()["bytes"]
    return (total or 0) <= max_bytes


def one_per_key(dim: DataFrame, key: str, newest: str | None = None) -> DataFrame:
    """One row per key. ``newest`` names the column whose largest value wins; ties, and
    tables without it, are settled by the remaining columns."""
    rest = [c for c in dim.columns if c != key]
    if newest is not None:
        rest.sort(key=lambda c: c != newest)
    best = dim.groupBy(key).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*[key if c == key else f"_best.{c}" for c in dim.columns])


def join_dimension(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Equi join of a large (or streaming) frame with one row per key of a static one.

    A dimension measured below ``max_bytes`` is broadcast: the facts are not moved. A
    larger one is joined by a shuffle on (key, salt), so the rows of one hot key are
    spread over ``salts`` tasks; each dimension row is copied once per salt. The copies are
    never broadcast, whatever Spark's own estimate of them is.
    """
    small = fits_broadcast(dim, max_bytes)
    single = dim.distinct() if dim.columns == [key] else one_per_key(dim, key)
    if small:
        return facts.join(F.broadcast(single), key, how)
    # The salt is a function of the row: a task that runs again salts it the same way.
    salt = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    copies = single.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    # Spark's estimate leaves out the copying: without the hint it may broadcast all copies.
    joined = facts.withColumn("_salt", salt).join(copies.hint("merge"), [key, "_salt"], how)
    return joined.drop("_salt")
