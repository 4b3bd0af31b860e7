"""Text lines in one column, ``value``, from a topic, a socket or a log folder."""

from pyspark.sql import DataFrame, SparkSession


def read_kafka_lines(
    spark: SparkSession, servers: str, topic: str, streaming: bool = True, **options
) -> DataFrame:
    """The values of a topic from its earliest offset on.

    Needs the Kafka connector on the cluster. ``maxOffsetsPerTrigger`` among ``options``
    bounds a micro-batch.
    """
    reader = spark.readStream if streaming else spark.read
    records = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )
    return records.selectExpr("cast(value as string) as value")


def read_socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket, for development."""
    return (
        spark.readStream.format("socket").option("host", host).option("port", port).load()
    )


def read_log_lines(
    spark: SparkSession,
    folder: str,
    pattern: str = "*log",
    streaming: bool = True,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Lines of the log files that appear in a folder.

    A file is read once and whole, so logs are rolled first and then moved in; the
    stream's checkpoint remembers which files have been read.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("text").option("pathGlobFilter", pattern)
    if streaming and files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder).select("value")
