"""The log source on files that grow, are rotated, emptied and removed."""

import os

import pytest

from roadstream.sources import appended, follow_log_lines
from roadstream.streaming import sinks


@pytest.fixture
def logs(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()

    class Logs:
        path = folder

        def append(self, name, data):
            with open(folder / name, "ab") as file:
                file.write(data.encode())

        def run(self, **options):
            """One run of the stream from its checkpoint; all lines so far."""
            lines = follow_log_lines(spark, str(folder), **options)
            query = sinks.start(lines, sinks.append_table(str(tmp_path / "table")), str(tmp_path / "ck"), available_now=True)
            query.awaitTermination(120)
            return sorted(r["value"] for r in spark.read.parquet(str(tmp_path / "table")).collect())

    return Logs()


def test_appended_lines_and_a_partial_one(logs):
    logs.append("a.log", "one\ntwo\nthr")
    logs.append("b.log", "x\r\n\n")
    logs.append("c.txt", "not a log\n")
    assert logs.run() == ["", "one", "two", "x"]
    assert logs.run() == ["", "one", "two", "x"]
    logs.append("a.log", "ee\nfour")
    logs.append("b.log", "y")
    assert logs.run() == ["", "one", "three", "two", "x"]
    logs.append("b.log", "\n")
    logs.append("a.log", "\n")
    assert logs.run() == ["", "four", "one", "three", "two", "x", "y"]


def test_a_rotated_file_goes_on(logs):
    logs.append("a.log", "one\ntw")
    assert logs.run() == ["one"]
    logs.append("a.log", "o\nthree\n")
    os.rename(logs.path / "a.log", logs.path / "a.log.1")
    logs.append("a.log", "new\n")
    assert logs.run() == ["new", "one", "three", "two"]


def test_an_emptied_file_is_read_anew(logs):
    logs.append("a.log", "one\ntwo\n")
    assert logs.run() == ["one", "two"]
    os.truncate(logs.path / "a.log", 0)
    logs.append("a.log", "3\n")
    assert logs.run() == ["3", "one", "two"]


def test_splits_cut_lines_once(logs):
    lines = [f"line {i} " + "é" * (i % 50) for i in range(300)]
    logs.append("a.log", "\n".join(lines) + "\n")
    assert logs.run(split_bytes=37) == sorted(lines)


def test_a_line_longer_than_splits_and_blocks(logs, monkeypatch):
    long = "x" * 3_000_000
    logs.append("a.log", long + "\nend")
    assert logs.run(split_bytes=1 << 20) == [long]
    logs.append("a.log", "\n")
    assert logs.run() == ["end", long]


def _reader(folder, **options):
    return appended.AppendedLinesReader({"path": str(folder), **options})


def _read(reader, split):
    return [v for b in reader.read(split) for v in b.column(0).to_pylist()]


def test_a_planned_range_is_read_again_alike(logs):
    """As after a lost executor: also when the file has grown and was renamed meanwhile."""
    logs.append("a.log", "one\ntwo\nth")
    reader = _reader(logs.path)
    (split,) = reader.partitions({}, reader.latestOffset())
    assert _read(reader, split) == ["one", "two"]
    logs.append("a.log", "ree\n")
    os.rename(logs.path / "a.log", logs.path / "a.log.7")
    assert _read(reader, split) == ["one", "two"]


def test_a_removed_file_is_an_error_or_skipped(logs):
    logs.append("a.log", "one\n")
    reader = _reader(logs.path)
    (split,) = reader.partitions({}, reader.latestOffset())
    os.remove(logs.path / "a.log")
    with pytest.raises(FileNotFoundError, match="gone before"):
        _read(reader, split)
    assert _read(_reader(logs.path, failOnDataLoss="false"), split) == []
    assert reader.latestOffset() == {}


def test_only_mounted_folders(logs):
    assert _reader(f"file://{logs.path}").folder == str(logs.path)
    with pytest.raises(ValueError, match="mounted"):
        _reader("hdfs://somewhere/logs")


def test_bytes_that_are_not_text(logs):
    with open(logs.path / "a.log", "wb") as file:
        file.write(b"\xff\xfe ok\n")
    assert logs.run() == ["�� ok"]
