"""Record layouts. Times are epoch milliseconds; ids are (zero padded) strings."""

from pyspark.sql import types as T


_KINDS = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def _schema(columns: str) -> T.StructType:
    # Unlike a DDL string this needs no running session.
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


# Line formats: the field order is the order of the comma separated values.
PASSAGE = _schema(
    "action_time bigint, monitor_id string, camera_id string, car string, "
    "speed double, road_id string, area_id string"
)
POLICE_ACTION = _schema(
    "police_id string, car string, action_status string, action_time bigint"
)
VIOLATION = _schema("car string, msg string, create_time bigint")

# Tables that are read.
MONITOR = _schema(
    "monitor_id string, road_id string, speed_limit int, area_id string"
)
VIOLATION_LIST = _schema("car string, violation string, create_time bigint")

# Tables that are written.
OVERSPEED = _schema(
    "car string, monitor_id string, road_id string, real_speed double, "
    "limit_speed int, action_time bigint"
)
AVERAGE_SPEED = _schema(
    "start_time bigint, end_time bigint, monitor_id string, avg_speed double, "
    "car_count bigint"
)
REPEAT_CAR = _schema(
    "car string, first_monitor_id string, second_monitor_id string, msg string, "
    "create_time bigint"
)
DANGEROUS_DRIVING = _schema(
    "car string, msg string, create_time bigint, real_speed double, limit_speed double"
)
TRACK = _schema(
    "row_key string, car string, action_time bigint, monitor_id string, "
    "road_id string, speed double"
)
