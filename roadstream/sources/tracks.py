"""Trajectory rows in a table ordered by their key.

Rows are range partitioned and sorted by ``row_key``, so that a car's rows lie together,
newest first. A small index names each file's first and last key: a point read opens the
files that can hold its key, in general one, and a car's trajectory the files of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream import schemas


def store_tracks(tracks: DataFrame, path: str, files: int | None = None) -> None:
    """Write the rows of ``track_rows`` to ``path``, replacing it; rows without a key are left out.
    ``files`` is the number of ranges; by default that of shuffle partitions. A car of many
    rows spreads over several, as its keys differ by time."""
    spark = tracks.sparkSession
    rows = tracks.where("row_key is not null")
    ranged = rows.repartitionByRange(*([files] if files else []), "row_key")
    (
        ranged.sortWithinPartitions("row_key")
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#row_key", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(f"{path}/rows")
    )
    stored = spark.read.schema(schemas.TRACK).parquet(f"{path}/rows")
    index = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key")
    )
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def _opened(spark: SparkSession, path: str, first: str, end: Column) -> DataFrame:
    """The rows of the files whose keys reach from ``first`` to ``end``."""
    index = spark.read.schema("file string, first_key string, last_key string").parquet(f"{path}/index")
    found = [r["file"] for r in index.where((F.col("last_key") >= first) & end).select("file").collect()]
    if not found:
        return spark.createDataFrame([], schemas.TRACK)
    return spark.read.schema(schemas.TRACK).parquet(*found)


def stored_row(spark: SparkSession, path: str, row_key: str) -> DataFrame:
    """The row stored under one key."""
    rows = _opened(spark, path, row_key, F.col("first_key") <= row_key)
    return rows.where(F.col("row_key") == row_key)


def stored_track(spark: SparkSession, path: str, car: str) -> DataFrame:
    """One car's trajectory, newest first; no rows for a car without one."""
    # Keys of a car begin with its name and an underscore, which a backtick follows.
    begin, end = f"row_{car}_", f"row_{car}`"
    rows = _opened(spark, path, begin, F.col("first_key") < end)
    within = (F.col("row_key") >= begin) & (F.col("row_key") < end)
    return rows.where(within & (F.col("car") == car)).orderBy(F.desc("action_time"))
