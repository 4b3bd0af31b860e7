"""Streams whose rows arrive late, shuffled and in many batches, against the batch operators."""

import os
import random

import pytest

from roadstream import schemas
from roadstream.operators import area_vehicle_count_running, dangerous_driving, parse_passages, repeat_plate
from roadstream.sources import read_log_lines
from roadstream.streaming import jobs, sinks
from roadstream.streaming.patterns import dangerous_driving_stream
from roadstream.streaming.repeats import repeat_plate_stream

BATCHES = 6


def _passages(seed, n=700, step=400):
    """Several passages a second, some at equal times, copies among them."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # Not from zero, which Spark takes for late.
        time = 1_000_000 + i * step - i * step % (3 * step) + rng.choice([0, 0, step])
        rows.append((time, f"m{rng.randrange(3)}", f"c{rng.randrange(4)}", f"car{rng.randrange(5)}", rng.choice([50.0, 75.5, 90.0]), "r", f"a{rng.randrange(2)}"))
    return rows + rows[:5]


def _logs(rows, folder, seed):
    """Rows that arrive up to five seconds late: sorted by a time of arrival, cut into logs."""
    rng = random.Random(seed)
    arrived = sorted(rows, key=lambda r: r[0] + rng.randrange(5000))
    folder.mkdir()
    size = -(-len(arrived) // BATCHES)
    for i in range(BATCHES):
        log = folder / f"{i}.log"
        log.write_text("".join(",".join(map(str, r)) + "\n" for r in arrived[i * size : (i + 1) * size]), encoding="utf-8")
        os.utime(log, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


@pytest.fixture
def case(spark, tmp_path):
    rows = _passages(3)
    folder = _logs(rows, tmp_path / "in", 4)
    settled = max(r[0] for r in rows) - 5000
    stream = parse_passages(read_log_lines(spark, folder, files_per_trigger=1))
    return spark.createDataFrame(rows, schemas.PASSAGE), stream, settled


def _run(spark, frame, tmp_path):
    path = str(tmp_path / "table")
    query = sinks.start(frame, sinks.append_table(path), str(tmp_path / "checkpoint"), available_now=True)
    query.awaitTermination(240)
    return sinks.read_appended(spark, path), query


def test_cloned_plates_do_not_depend_on_arrival(spark, case, rows, tmp_path):
    batch, stream, settled = case
    got, _ = _run(spark, repeat_plate_stream(stream, 3_000), tmp_path)
    want = repeat_plate(batch, 3_000).where(f"create_time <= {settled}")
    assert want.count() > 100 and rows(got) == rows(want)


def test_state_is_empty_after_the_gap(spark, tmp_path):
    """A late passage moves the watermark a gap past all others."""
    day = 24 * 3_600_000
    folder = _logs([*_passages(5, 60), (day, "m", "c", "other", 1.0, "r", "a"), (2 * day, "m", "c", "other", 1.0, "r", "a")], tmp_path / "in", 1)
    stream = parse_passages(read_log_lines(spark, folder, files_per_trigger=1))
    _, query = _run(spark, repeat_plate_stream(stream, 3_000), tmp_path)
    left = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(left) > 1 and left[-1] == 1  # the last passage itself waits


def test_runs_of_dangerous_driving_with_their_text(spark, case, monitors, rows, tmp_path):
    batch, stream, settled = case
    limits = monitors(("m0", "r0", 60, "a"), ("m1", "r1", 70, "a"))
    got, _ = _run(spark, dangerous_driving_stream(stream, limits, span_ms=6_000), tmp_path)
    names = ("car", "msg", "create_time", "real_speed", "limit_speed", "n_events")
    found = rows(got, *names)
    want = rows(dangerous_driving(batch, limits, span_ms=6_000), *names)
    # A run is given once its last passage has settled; its text ends with that passage's time.
    last = lambda row: int(row[1].rsplit(",", 1)[1].split(")")[0])
    severe = max(r["action_time"] for r in batch.collect())
    assert severe - 5000 == settled and len(want) > 500
    assert found == [w for w in want if last(w) <= max(map(last, found))]
    assert max(map(last, found)) > settled - 10_000


def test_running_counts_of_every_passage(spark, case, rows, tmp_path):
    batch, stream, settled = case
    path, state = str(tmp_path / "table"), str(tmp_path / "state")
    query = jobs.running_count_job(stream, path, state, str(tmp_path / "checkpoint"), size_ms=20_000, available_now=True)
    query.awaitTermination(240)
    want = area_vehicle_count_running(batch, 20_000)
    got = sinks.read_appended(spark, path).select(*want.columns)
    want = want.where(f"action_time <= {settled}")
    assert want.count() > 500 and rows(got) == rows(want)
    # Between batches only the windows are carried that the watermark has not passed.
    carried = spark.read.parquet(f"{state}/counts")
    assert carried.groupBy("after_batch", "area_id").count().agg({"count": "max"}).first()[0] <= 1
    assert spark.read.parquet(f"{state}/waiting").agg({"action_time": "min"}).first()[0] > settled - 60_000


def test_running_counts_of_a_replayed_batch(spark, rows, tmp_path):
    """A batch that runs again, as after a failure, begins with the state before it."""
    from roadstream.streaming.counts import counts_sink

    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    write = counts_sink(path, state, size_ms=10_000, delay_ms=1_000)
    names = "action_time long, area_id string, car string, camera_id string"

    def batch(*seen):
        return spark.createDataFrame([(t, "a", c, "x") for t, c in seen], names)

    write(batch((1_000, "p"), (2_000, "q")), 0)
    for _ in range(2):
        write(batch((1_500, "q"), (500, "late"), (4_000, "p"), (None, "n")), 1)
    for _ in range(2):
        write(batch(), 2)
    write(batch((30_000, "r")), 3)
    got = rows(spark.read.parquet(path), "action_time", "car", "car_count")
    # The passage at 1.5 s came in time and ahead of the one at 2 s.
    assert got == [(1_000, "p", 1), (1_500, "q", 2), (2_000, "q", 2), (4_000, "p", 2)]
