"""Dimension tables: from a database, from files, and as one row per key."""

from pyspark.sql import DataFrame, SparkSession

from roadstream import schemas
from roadstream.plans import one_per_key


def jdbc_table(
    spark: SparkSession, url: str, query: str, properties: dict | None = None
) -> DataFrame:
    """The rows of a SQL query at a database; filters and columns are pushed into it."""
    reader = spark.read.format("jdbc").option("url", url)
    return reader.option("dbtable", f"({query}) t").options(**(properties or {})).load()


def read_monitors(
    spark: SparkSession, url: str, properties: dict | None = None
) -> DataFrame:
    """All monitors with their road, limit and area."""
    return jdbc_table(
        spark,
        url,
        "select monitor_id, road_id, speed_limit, area_id from t_monitor_info",
        properties,
    )


def read_violation_list(
    spark: SparkSession, url: str, properties: dict | None = None
) -> DataFrame:
    """The cars under watch."""
    return jdbc_table(
        spark, url, "select car, violation, create_time from t_violation_list", properties
    )


def monitors_snapshot(monitors: DataFrame) -> DataFrame:
    """Monitors with one row per id."""
    return one_per_key(
        monitors.select(*schemas.MONITOR.fieldNames()), "monitor_id", "speed_limit"
    )


def violation_list_snapshot(violation_list: DataFrame) -> DataFrame:
    """Cars under watch with the newest entry of each."""
    return one_per_key(
        violation_list.select(*schemas.VIOLATION_LIST.fieldNames()), "car", "create_time"
    )
