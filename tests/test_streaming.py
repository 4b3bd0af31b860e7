"""Streams from log files against the batch operators on the same passages."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from roadstream import testmap
from roadstream.operators import (
    area_vehicle_count,
    area_vehicle_count_bloom,
    area_vehicle_count_running,
    average_speed,
    dangerous_driving,
    dangerous_pairs,
    overspeed,
    parse_passages,
    parse_police_actions,
    parse_violations,
    police_interval_join,
    police_match,
    repeat_plate,
    repeat_plate_daily,
    severe_overspeed,
    top_congested,
    track_rows,
    watchlist_passages,
    with_speed_limits,
)
from roadstream.sources import read_log_lines
from roadstream.streaming import jobs, sinks
from roadstream.streaming.repeats import repeat_plate_stream

HOUR = 3_600_000
DAY = 24 * HOUR
FILES = 3


def _write_logs(frame, time_col, folder):
    """Rolled logs in order of time; each becomes a micro-batch."""
    folder.mkdir()
    rows = frame.orderBy(time_col).collect()
    size = -(-len(rows) // FILES)
    for i in range(FILES):
        lines = [",".join(map(str, row)) for row in rows[i * size : (i + 1) * size]]
        log = folder / f"{i}.log"
        log.write_text("\n".join(lines) + "\n", encoding="utf-8")
        # Files are read in the order of their times of change.
        os.utime(log, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("logs")
    return {
        "passages": _write_logs(
            testmap.passages(spark, SMALL), "action_time", base / "passages"
        ),
        "actions": _write_logs(
            testmap.police_actions(spark, SMALL), "action_time", base / "actions"
        ),
        "violations": _write_logs(
            testmap.violations(spark, SMALL), "create_time", base / "violations"
        ),
    }


@pytest.fixture
def stream(spark, logs):
    def open_(kind="passages", parse=parse_passages):
        return parse(read_log_lines(spark, logs[kind], files_per_trigger=1))

    return open_


@pytest.fixture
def batch(spark, logs):
    return parse_passages(read_log_lines(spark, logs["passages"], streaming=False))


@pytest.fixture
def run(spark, tmp_path):
    """Write a stream to a table until the input is read, and read the table."""

    def go(frame, mode="append"):
        path = str(tmp_path / "table")
        query = sinks.start(
            frame,
            sinks.append_table(path),
            str(tmp_path / "checkpoint"),
            mode=mode,
            available_now=True,
        )
        query.awaitTermination(240)
        assert query.exception() is None
        return spark.read.parquet(path)

    return go


@pytest.fixture
def done(tmp_path):
    """Arguments of a job that stops once the input is read."""
    return {"checkpoint": str(tmp_path / "checkpoint"), "available_now": True}


def _wait(query):
    query.awaitTermination(240)
    assert query.exception() is None


def _closed(frame, batch, delay_ms=5_000):
    last = batch.agg(F.max("action_time")).first()[0]
    return frame.where(F.col("end_time") <= last - delay_ms)


def test_source_and_parser(stream, batch, run, rows):
    assert batch.count() == 1_000
    assert rows(run(stream()).drop("batch_id")) == rows(batch)


def test_dimension_operators_run_on_streams(spark, stream, batch, run, rows):
    dim = testmap.monitors(spark, SMALL)
    got = run(overspeed(stream(), dim)).drop("batch_id")
    assert rows(got) == rows(overspeed(batch, dim))


def test_limits_run_on_streams(spark, stream, batch, run, rows):
    dim = testmap.monitors(spark, SMALL)
    got = run(with_speed_limits(stream(), dim)).drop("batch_id")
    assert rows(got) == rows(with_speed_limits(batch, dim))


def test_average_speed(stream, batch, run, rows):
    got = run(average_speed(stream(), 5 * HOUR, HOUR)).drop("batch_id")
    expected = _closed(average_speed(batch, 5 * HOUR, HOUR), batch)
    assert rows(got) == rows(expected)


def test_late_rows_are_dropped(spark, run, rows, tmp_path):
    """A row whose windows have all closed changes nothing; others still count."""
    folder = tmp_path / "late"
    folder.mkdir()
    batches = [[0, 100_000], [110_000], [30_000, 90_000], [200_000]]
    for i, times in enumerate(batches):
        log = folder / f"{i}.log"
        log.write_text("\n".join(f"{t},m,c,a,10.0,r,x" for t in times), encoding="utf-8")
        os.utime(log, (1_700_000_000 + i, 1_700_000_000 + i))
    lines = read_log_lines(spark, str(folder), files_per_trigger=1)
    got = run(average_speed(parse_passages(lines), 60_000, 60_000))
    # Lateness is judged by the watermark of the batch before, which is 95 s for the
    # third log: the window from 0 s has closed, the one from 60 s has not.
    assert rows(got, "start_time", "car_count") == [(0, 1), (60_000, 3)]


def test_area_counts(stream, batch, run, rows):
    got = run(area_vehicle_count(stream(), DAY)).drop("batch_id")
    assert rows(got) == rows(_closed(area_vehicle_count(batch, DAY), batch))


def test_approximate_area_counts(stream, batch, run, rows):
    got = run(area_vehicle_count_bloom(stream(), DAY)).drop("batch_id")
    assert rows(got) == rows(_closed(area_vehicle_count_bloom(batch, DAY), batch))


def test_running_area_counts_end_at_the_count(spark, stream, batch, rows, tmp_path, done):
    path = str(tmp_path / "table")
    _wait(jobs.area_count_job(stream(), sinks.upsert_by_key(path), size_ms=DAY, **done))
    latest = sinks.read_latest(spark, path, "area_id", "start_time")
    expected = area_vehicle_count(batch, DAY)
    assert rows(latest.select(*expected.columns)) == rows(expected)
    final = area_vehicle_count_running(batch, DAY).groupBy(
        "area_id", "start_time", "end_time"
    )
    assert rows(final.agg(F.max("car_count"))) == rows(expected)


def test_interval_join(stream, spark, logs, run, rows):
    actions = stream("actions", parse_police_actions)
    violations = stream("violations", parse_violations)
    got = run(police_interval_join(actions, violations, 6 * HOUR)).drop("batch_id")
    expected = police_interval_join(
        testmap.police_actions(spark, SMALL), testmap.violations(spark, SMALL), 6 * HOUR
    )
    assert rows(got) == rows(expected)


def test_match(stream, spark, run, rows):
    actions = stream("actions", parse_police_actions)
    violations = stream("violations", parse_violations)
    got = run(police_match(actions, violations, 6 * HOUR)).drop("batch_id")
    a, v = testmap.police_actions(spark, SMALL), testmap.violations(spark, SMALL)
    expected = police_match(a, v, 6 * HOUR)
    # The newest rows without partner stay in state.
    end = min(
        a.agg(F.max("action_time")).first()[0], v.agg(F.max("create_time")).first()[0]
    )
    settled = (
        F.coalesce(F.greatest("action_time", "create_time"), F.lit(0)) < end - 13 * HOUR
    )
    assert rows(got.where(settled)) == rows(expected.where(settled))
    assert set(rows(got)) <= set(rows(expected))


def test_pattern_pairs(spark, stream, batch, run, rows):
    dim = testmap.monitors(spark, SMALL)
    got = run(dangerous_pairs(severe_overspeed(stream(), dim), DAY))
    expected = dangerous_driving(batch, dim, DAY)
    keys = ("car", "create_time", "real_speed", "limit_speed")
    assert rows(got, *keys) == rows(expected, *keys)


def test_repeat_plate(stream, batch, run, rows):
    got = run(repeat_plate_stream(stream(), HOUR // 2)).drop("batch_id")
    assert rows(got) == rows(repeat_plate(batch, HOUR // 2))


def test_repeat_plate_job(spark, stream, batch, rows, tmp_path, done):
    path = str(tmp_path / "table")
    _wait(jobs.repeat_plate_job(stream(), path, gap_ms=HOUR // 2, **done))
    expected = repeat_plate_daily(repeat_plate(batch, HOUR // 2))
    stored = spark.read.parquet(path).select(*expected.columns)
    assert rows(stored) == rows(expected)


def test_congestion_job(spark, stream, batch, rows, tmp_path, done):
    path = str(tmp_path / "table")
    sink = sinks.append_table(path)
    _wait(
        jobs.congestion_job(stream(), sink, size_ms=5 * HOUR, slide_ms=2 * HOUR, **done)
    )
    expected = _closed(top_congested(batch, 3, 5 * HOUR, 2 * HOUR), batch)
    assert rows(sinks.read_appended(spark, path)) == rows(expected)


def test_average_speed_job(spark, stream, batch, rows, tmp_path, done):
    path = str(tmp_path / "table")
    sink = sinks.append_table(path)
    _wait(jobs.average_speed_job(stream(), sink, size_ms=HOUR, slide_ms=HOUR, **done))
    expected = _closed(average_speed(batch, HOUR, HOUR), batch)
    assert rows(sinks.read_appended(spark, path)) == rows(expected)


def test_track_job(spark, stream, batch, rows, tmp_path, done):
    path = str(tmp_path / "table")
    watch = testmap.violation_list(spark, SMALL)
    _wait(jobs.track_job(stream(), lambda: watch, sinks.append_table(path), **done))
    expected = track_rows(watchlist_passages(batch, watch))
    assert rows(sinks.read_appended(spark, path)) == rows(expected)


def test_police_job(spark, stream, tmp_path, done):
    path = str(tmp_path / "table")
    actions = stream("actions", parse_police_actions)
    violations = stream("violations", parse_violations)
    _wait(
        jobs.police_job(
            actions, violations, sinks.append_table(path), tolerance_ms=6 * HOUR, **done
        )
    )
    kinds = {r.kind for r in sinks.read_appended(spark, path).collect()}
    assert kinds == {"matched", "action_only", "violation_only"}


def test_dimension_is_read_anew_for_each_batch(spark, stream, tmp_path, done):
    """The limit drops after the first batch; only later passages are affected."""
    path, reads = str(tmp_path / "table"), []

    def monitors():
        reads.append(1)
        limit = 10_000 if len(reads) == 1 else 1
        return testmap.monitors(spark, SMALL).withColumn("speed_limit", F.lit(limit))

    _wait(jobs.overspeed_job(stream(), monitors, sinks.append_table(path), **done))
    assert len(reads) == FILES
    batches = spark.read.parquet(path).groupBy("batch_id").count().collect()
    assert sorted(r.batch_id for r in batches) == [1, 2]


def test_restart_goes_on_from_the_checkpoint(spark, logs, rows, tmp_path):
    """New logs after a stop: windows and anchors carry over."""
    path, folder = tmp_path / "table", tmp_path / "in"
    folder.mkdir()
    for i in range(FILES):
        text = open(f"{logs['passages']}/{i}.log", encoding="utf-8").read()
        (folder / f"{i}.log").write_text(text, encoding="utf-8")
        lines = parse_passages(read_log_lines(spark, str(folder)))
        _wait(
            sinks.start(
                repeat_plate_stream(lines, HOUR // 2),
                sinks.append_table(str(path)),
                str(tmp_path / "checkpoint"),
                available_now=True,
            )
        )
    batch = parse_passages(read_log_lines(spark, str(folder), streaming=False))
    expected = repeat_plate(batch, HOUR // 2)
    assert rows(sinks.read_appended(spark, str(path))) == rows(expected)
