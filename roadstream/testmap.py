"""Traffic frames derived from the driver's generic tables, for tests and benchmarks."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The columns that are used, so that no file is opened to learn its schema.
_COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "part": "p_partkey bigint, p_brand string, p_size int",
    "customer": "c_custkey bigint, c_mktsegment string",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def _events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table, a file or a folder of files, as a stream of files."""
    reader = spark.readStream.schema(_COLUMNS["events"]).format("parquet")
    # A stream takes a single file only by way of a pattern.
    return reader.load(f"{folder}/event[s].parquet")


def _millis() -> Column:
    # ``ts`` has no zone and is read as UTC, whatever the session time zone.
    local = F.col("ts").cast("timestamp")
    return F.unix_millis(F.from_utc_timestamp(local, F.current_timezone()))


def passages_from(events: DataFrame) -> DataFrame:
    """Sign-ups pass monitors that no table knows."""
    k = F.get_json_object("props", "$.k")
    unknown = F.col("event_type") == "signup"
    return events.select(
        _millis().alias("action_time"),
        F.when(unknown, F.concat(F.lit("u"), k)).otherwise(k).alias("monitor_id"),
        (F.col("event_id") % 1000).cast("string").alias("camera_id"),
        F.col("user_id").cast("string").alias("car"),
        F.col("value").alias("speed"),
        (k.cast("int") % 10).cast("string").alias("road_id"),
        F.col("event_type").alias("area_id"),
    )


def police_actions_from(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "purchase").select(
        F.col("event_id").cast("string").alias("police_id"),
        F.col("user_id").cast("string").alias("car"),
        F.col("event_type").alias("action_status"),
        _millis().alias("action_time"),
    )


def violations_from(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "error").select(
        F.col("user_id").cast("string").alias("car"),
        F.col("event_type").alias("msg"),
        _millis().alias("create_time"),
    )


def passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages_from(_table(spark, folder, "events"))


def police_actions(spark: SparkSession, folder: str) -> DataFrame:
    return police_actions_from(_table(spark, folder, "events"))


def violations(spark: SparkSession, folder: str) -> DataFrame:
    return violations_from(_table(spark, folder, "events"))


def passages_stream(spark: SparkSession, folder: str) -> DataFrame:
    return passages_from(_events_stream(spark, folder))


def police_actions_stream(spark: SparkSession, folder: str) -> DataFrame:
    return police_actions_from(_events_stream(spark, folder))


def violations_stream(spark: SparkSession, folder: str) -> DataFrame:
    return violations_from(_events_stream(spark, folder))


def monitors(spark: SparkSession, folder: str) -> DataFrame:
    """A monitor for each part, some with limit 0; every seventh occurs twice, the second
    time with an older, lower limit."""
    key = F.col("p_partkey")
    parts = _table(spark, folder, "part").withColumn(
        "_cut", F.explode(F.when(key % 7 == 0, F.array(F.lit(5), F.lit(15))).otherwise(F.array(F.lit(5))))
    )
    return parts.select(
        key.cast("string").alias("monitor_id"),
        (key % 10).cast("string").alias("road_id"),
        F.greatest(F.col("p_size") - F.col("_cut"), F.lit(0)).alias("speed_limit"),
        F.col("p_brand").alias("area_id"),
    )


def violation_list(spark: SparkSession, folder: str) -> DataFrame:
    """A watched car for each customer, a third of all car numbers; every fifth is listed
    twice."""
    key = F.col("c_custkey")
    listed = _table(spark, folder, "customer").withColumn(
        "_time", F.explode(F.when(key % 5 == 0, F.array(key, key + 7)).otherwise(F.array(key)))
    )
    return listed.select(
        (key * 3).cast("string").alias("car"),
        F.concat("c_mktsegment", F.lit(" "), F.col("_time") % 3).alias("violation"),
        F.col("_time").alias("create_time"),
    )
