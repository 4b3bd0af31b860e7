"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from roadstream.plans import files, working_folder

#: Rows that one salt of ``numbered`` holds on average.
ROWS_PER_SALT = 200_000
LEAST_SALTS = 64


def own_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder that the session names."""
    return f"{working_folder(spark)}/roadstream-{uuid.uuid4().hex}"


#: Folders of the tables that each open ``scratch`` has seen written.
_SCRATCH: list[list[str]] = []


def written(df: DataFrame, keep: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there, and later steps
    read the columns they need. With ``keep`` it outlives the innermost ``scratch``."""
    spark = df.sparkSession
    path = own_folder(spark)
    scopes = _SCRATCH[:-1] if keep else _SCRATCH
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are ``written`` inside are removed at its end, also after an error. What is
    needed beyond must have been written with ``keep`` by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            files.remove(spark, path)


def row_names(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns that name a row whatever way its files are split, and their names:
    the file and the row's place in it. Rows that do not come straight from files are written
    with a number first."""
    under = "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in docs.columns), default=0))
    file, place = under + "file", under + "place"
    try:
        return docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place)), [file, place]
    except AnalysisException as missing:
        if not (missing.getCondition() or "").startswith(("UNRESOLVED_COLUMN", "FIELD_NOT_FOUND")):
            raise
    numbered = docs.select("*", F.lit("").alias(file), F.monotonically_increasing_id().alias(place))
    return written(numbered), [file, place]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_arrow(
    df: DataFrame, schema: str | StructType, work: Callable[[Iterator[dict]], Iterable[dict]]
) -> DataFrame:
    """``df.mapInArrow`` where ``work`` gets each batch as a dict of Arrow arrays and
    yields dicts of columns; a batch is cut so that its Python objects stay small."""
    _bound_batches(df.sparkSession)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns() -> Iterator[dict]:
            for batch in batches:
                for part in small_batches(batch):
                    yield dict(zip(part.schema.names, part.columns, strict=True))

        for out in work(columns()):
            arrays = [
                out[f.name]
                if isinstance(out[f.name], pa.Array)
                else pa.array(out[f.name], f.type, from_pandas=False)
                for f in target
            ]
            yield pa.RecordBatch.from_arrays(
                [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, target, strict=True)],
                schema=target,
            )

    return df.mapInArrow(run, schema)


#: Rows that Spark hands to Python at a time, where the session does not say: its default of
#: ten thousand whole texts would be tens of megabytes on both sides, or gigabytes.
ARROW_ROWS, ARROW_BYTES = 1024, 8 << 20


def _bound_batches(spark: SparkSession) -> None:
    prefix = "spark.sql.execution.arrow"
    for key, value in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        if spark.conf.get(f"{prefix}.{key}", None) is None:
            spark.conf.set(f"{prefix}.{key}", str(value))


#: Bytes of a batch that is turned into Python objects at once. Arrays over characters take
#: some thirty times as much.
BATCH_BYTES = 2 << 20


def small_batches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BATCH_BYTES``, one row at least."""
    step = max(1, int(batch.num_rows * BATCH_BYTES / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def numbered(
    df: DataFrame, group: list[str], order: list[str], name: str, start: int = 0
) -> DataFrame:
    """Number the rows of each group from ``start`` without gaps, in a fixed order.

    A group is split by a hash of ``order`` into salts that are numbered apart and put
    one after another, so that a group of any size spreads over many tasks. ``df`` should
    be a written table and ``order`` tell its rows apart.
    """
    rows = df.count()
    salts = max(LEAST_SALTS, rows // ROWS_PER_SALT)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    sizes = salted.groupBy(*group, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", before_this(F.col("_n"), group, ["_salt"]))
    w = _window([*group, "_salt"], order)
    local = salted.withColumn("_nth", F.row_number().over(w).cast("bigint") - 1)
    keys = [*group, "_salt"]
    return (
        local.join(F.broadcast(before.drop("_n")) if not group else before.drop("_n"), keys)
        .withColumn(name, F.col("_nth") + F.col("_before") + start)
        .drop("_nth", "_before", "_salt")
    )


def before_this(size: Column, group: list[str], order: list[str]) -> Column:
    """The sum of ``size`` over the rows before this one in its group."""
    w = _window(group, order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(w), F.lit(0)).cast("bigint")


def _window(group: list[str], order: list[str]):
    return Window.partitionBy(*(group or [F.lit(0)])).orderBy(*order)
