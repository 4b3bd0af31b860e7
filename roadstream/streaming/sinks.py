"""Sinks as ``foreachBatch`` functions.

Each batch owns the folder ``batch_id=N`` of its table and a replay of the batch replaces
that folder, so every batch is stored once. A table belongs to one checkpoint: a query
that starts over with a new checkpoint needs a new table.
"""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadstream import schemas
from roadstream.functions.timing import local_day
from roadstream.operators.repeats import repeat_plate_daily
from roadstream.plans import files, shared_folder

Sink = Callable[[DataFrame, int], None]


def as_table(frame: DataFrame, schema: T.StructType, **sources: str) -> DataFrame:
    """``frame`` with the columns and types of a table that is written.

    ``sources`` names the frame's column where the table calls it differently.
    """
    return frame.select(
        *[
            F.col(sources.get(f.name, f.name)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def repeat_car_table(warnings: DataFrame) -> DataFrame:
    """Cloned-plate warnings as stored in a database: its columns say monitor, but hold
    the cameras."""
    return as_table(
        warnings,
        schemas.REPEAT_CAR,
        first_monitor_id="first_camera_id",
        second_monitor_id="second_camera_id",
    )


def append_table(path: str, time_col: str | None = None, zone: str = "UTC") -> Sink:
    """Append every batch to a Parquet table.

    With ``time_col``, a batch is also split into folders by the ``day`` of that column,
    so that readers of some days skip the files of all others.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch_id={batch_id}"
        if time_col is None:
            batch.write.mode("overwrite").parquet(folder)
        else:
            # Replaces the batch's folder as a whole, whatever the session's setting.
            (
                batch.withColumn("day", local_day(F.col(time_col), zone))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .partitionBy("day")
                .parquet(folder)
            )

    return write


def read_appended(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """The rows of all batches, with ``day`` where the table is split by it.

    With ``schema``, a table of which no batch has been written yet is empty; without it
    that is an error, as its columns are unknown."""
    try:
        return spark.read.parquet(path).drop("batch_id")
    except AnalysisException as missing:
        if schema is None or missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def split_by_kind(
    path: str, kinds: tuple[str, ...], report: Callable[[int, dict[str, int]], None] | None = None
) -> Sink:
    """Append every batch to one table for each ``kind``, in one pass over the batch.

    The kinds are folders of the batch's own folder. They are counted while they are written;
    ``report`` gets the batch's number and the rows of every kind in ``kinds``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        counted = Observation()
        counts = [F.count_if(F.col("kind") == k).alias(k) for k in kinds]
        (
            batch.observe(counted, *counts)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("kind")
            .parquet(f"{path}/batch_id={batch_id}")
        )
        if report is not None:
            report(batch_id, counted.get)

    return write


def read_kind(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The rows of one kind; the folders of the others are not read."""
    return spark.read.parquet(path).where(F.col("kind") == kind).drop("kind", "batch_id")


def append_jdbc(url: str, table: str, properties: dict | None = None) -> Sink:
    """Append every batch to a database table, written by all tasks in parallel.

    A replayed batch is inserted again unless the table's key refuses it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.jdbc(url, table, mode="append", properties=properties or {})

    return write


def insert_if_absent(path: str, zone: str = "UTC") -> Sink:
    """Store the first cloned-plate warning of each car and day, over all batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = repeat_plate_daily(batch, zone).persist()
        try:
            # Days are folders: the batch's own are listed and read, however many there are.
            days = [r["day"] for r in fresh.select("day").distinct().collect()]
            folders = [f"{path}/day={day}" for day in days if day is not None]
            stored = [f for f in folders if files.exists(spark, f)]
            absent = fresh
            if stored:
                schema = T.StructType([*fresh.schema.fields, T.StructField("batch_id", T.IntegerType())])
                table = spark.read.schema(schema).option("basePath", path).parquet(*stored)
                known = table.where(F.col("batch_id") < batch_id).select("car", "day")
                absent = fresh.join(known, ["car", "day"], "left_anti")
            (
                absent.withColumn("batch_id", F.lit(batch_id))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("day", "batch_id")
                .parquet(path)
            )
        finally:
            fresh.unpersist()

    return write


def upsert_by_key(path: str) -> Sink:
    """Store rows of which a later batch replaces those with the same key."""
    return append_table(path)


def read_latest(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """The newest row of every key. A filter on the key reaches the table scan."""
    table = spark.read.parquet(path)
    rest = [c for c in table.columns if c not in (*keys, "batch_id")]
    newest = table.groupBy(*keys).agg(F.max(F.struct("batch_id", *rest)).alias("_row"))
    return newest.select(*keys, *[f"_row.{c}" for c in rest])


def checkpoint_folder(spark: SparkSession, name: str) -> str:
    """A stream's checkpoint below the cluster's shared folder."""
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir or pass the checkpoint folder")
    return f"{folder}/streams/{name}"


def start(
    frame: DataFrame,
    sink: Sink,
    checkpoint: str,
    mode: str = "append",
    available_now: bool = False,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Run a stream into a sink; ``available_now`` stops once the present input is read."""
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        frame.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
        .trigger(**trigger)
        .start()
    )


def console(frame: DataFrame, mode: str = "append") -> StreamingQuery:
    return frame.writeStream.outputMode(mode).format("console").start()


def relay_to_topic(
    lines: DataFrame, servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    """Send lines to a topic. Needs the Kafka connector on the cluster."""
    return (
        lines.select("value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
