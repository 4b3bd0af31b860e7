"""The cluster's shared folder, and cutting a plan there."""

import re

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str | None:
    """The folder named by ``spark.checkpoint.dir``, or None when it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.sparkContext.getCheckpointDir()


def working_folder(spark: SparkSession) -> str:
    """The shared folder. Where none is set, a local master may use Spark's own local
    folder, as driver and tasks are one process; a cluster must name one."""
    folder = shared_folder(spark)
    if folder is not None:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.sparkContext.getConf().get("spark.local.dir", "/tmp").split(",")[0].rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there.

    For a frame that several branches of a plan read. Without a shared folder the frame
    is returned as it is: the branches recompute it and the result is the same.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if df.isStreaming or folder is None:
        return df
    if spark.sparkContext.getCheckpointDir() is None:
        # The setting was made after the context had started.
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
