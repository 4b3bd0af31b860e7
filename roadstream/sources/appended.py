"""A streaming source that follows log files while they grow.

The offset is a map from a file's identity to the byte up to which it has been read. A line
belongs to the range of bytes in which its line feed lies, so that a partial last line waits
for the rest, and a range of any size can be cut into splits that are read on their own: each
goes back to the start of its first line. A file that is renamed keeps its identity and goes
on where it was.
"""

from __future__ import annotations

import fnmatch
import os
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The source travels to the executors with the plan; the package need not be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT_BYTES = 64 << 20
_BLOCK = 1 << 20
_LINES = 8192


def _local(folder: str) -> str:
    parts = urlparse(folder)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{folder}: files that grow are followed in a mounted folder")
    return unquote(parts.path) if parts.scheme else folder


def _identity(stat: os.stat_result) -> str:
    return f"{stat.st_dev}:{stat.st_ino}"


@dataclass
class Split(InputPartition):
    """Bytes ``begin`` to ``end`` of a file, found under ``path`` when they were planned."""

    path: str
    identity: str
    begin: int
    end: int


class AppendedLines(DataSource):
    """Options: ``path``, ``pattern``, ``rotated``, ``splitBytes``, ``failOnDataLoss``."""

    @classmethod
    def name(cls) -> str:
        return "appended_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> AppendedLinesReader:
        return AppendedLinesReader(self.options)


class AppendedLinesReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.folder = _local(options["path"])
        pattern = options.get("pattern", "*log")
        self.patterns = [pattern, options.get("rotated", f"{pattern}.[0-9]*")]
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        self.fail = options.get("failOnDataLoss", "true").lower() != "false"

    def _files(self) -> Iterator[tuple[str, os.stat_result]]:
        with os.scandir(self.folder) as found:
            for entry in found:
                if any(fnmatch.fnmatch(entry.name, p) for p in self.patterns) and entry.is_file():
                    yield entry.path, entry.stat()

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Each file's size; one that has vanished is no longer listed."""
        return {_identity(s): {"path": path, "end": s.st_size} for path, s in sorted(self._files())}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        out = []
        for identity, to in end.items():
            begin = start.get(identity, {"end": 0})["end"]
            if begin > to["end"]:
                begin = 0  # the file was emptied and is written anew
            for at in range(begin, to["end"], self.split_bytes):
                out.append(Split(to["path"], identity, at, min(at + self.split_bytes, to["end"])))
        return out

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        path = self._path_of(partition)
        if path is not None:
            with open(path, "rb") as file:
                yield from _batches(_lines(file, partition.begin, partition.end))

    def _path_of(self, split: Split) -> str | None:
        """The file's present name, as it may have been renamed since."""
        try:
            if _identity(os.stat(split.path)) == split.identity:
                return split.path
        except FileNotFoundError:
            pass
        for path, stat in self._files():
            if _identity(stat) == split.identity:
                return path
        if self.fail:
            raise FileNotFoundError(f"{split.path}: gone before bytes {split.begin} to {split.end} were read")
        return None


def _line_start(file, at: int) -> int:
    """Where the line that holds byte ``at`` begins."""
    while at > 0:
        size = min(at, _BLOCK)
        file.seek(at - size)
        found = file.read(size).rfind(b"\n")
        if found >= 0:
            return at - size + found + 1
        at -= size
    return 0


def _lines(file, begin: int, end: int) -> Iterator[bytes]:
    """The lines whose line feed lies from ``begin`` to ``end``."""
    at = _line_start(file, begin)
    file.seek(at)
    rest: list[bytes] = []
    while at < end:
        block = file.read(min(_BLOCK, end - at))
        if not block:
            return  # cut short since it was planned
        at += len(block)
        first, *others = block.split(b"\n")
        rest.append(first)
        if others:
            yield b"".join(rest)
            yield from others[:-1]
            rest = [others[-1]]


def _batches(lines: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    held: list[str] = []
    for line in lines:
        held.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
        if len(held) == _LINES:
            yield pa.RecordBatch.from_pydict({"value": held})
            held = []
    if held:
        yield pa.RecordBatch.from_pydict({"value": held})


def follow_log_lines(
    spark: SparkSession,
    folder: str,
    pattern: str = "*log",
    rotated: str | None = None,
    split_bytes: int = SPLIT_BYTES,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """A stream of the lines of log files, those that are appended later included.

    ``folder`` is mounted at the same place on all machines. Files whose names match
    ``pattern`` are read from their first byte, and so are those that match ``rotated``, by
    default the pattern and a dot and a number. A line counts once its line feed is there.
    A file that is renamed within these names is not read again; one that has become shorter is
    read from its start; one that is removed before it was read ends the stream with an error
    unless ``fail_on_data_loss`` is false. Bytes that are not UTF-8 become replacement characters.
    A batch holds all that has come since the last one, in splits of ``split_bytes``.
    """
    spark.dataSource.register(AppendedLines)
    reader = spark.readStream.format("appended_lines").option("pattern", pattern).option("splitBytes", split_bytes)
    if rotated is not None:
        reader = reader.option("rotated", rotated)
    return reader.option("failOnDataLoss", str(fail_on_data_loss).lower()).load(folder)
