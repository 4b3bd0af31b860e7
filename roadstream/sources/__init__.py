"""Where lines and dimension tables come from."""

from roadstream.sources.appended import follow_log_lines
from roadstream.sources.lines import read_kafka_lines, read_log_lines, read_socket_lines
from roadstream.sources.tables import (
    jdbc_table,
    monitors_snapshot,
    read_monitors,
    read_violation_list,
    violation_list_snapshot,
)

__all__ = [
    "follow_log_lines",
    "jdbc_table",
    "monitors_snapshot",
    "read_kafka_lines",
    "read_log_lines",
    "read_monitors",
    "read_socket_lines",
    "read_violation_list",
    "violation_list_snapshot",
]
