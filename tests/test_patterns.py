import random

import pytest

from roadstream.operators import dangerous_driving

COLUMNS = ("car", "create_time", "real_speed", "limit_speed", "n_events")


def test_every_run(passages, monitors, rows):
    frame = passages(
        (0, "m", "c", "a", 80.0),
        (10_000, "m", "c", "a", 60.0),
        (20_000, "m", "c", "a", 90.0),
        (30_000, "m", "c", "a", 99.5),
        (31_000, "m", "c", "b", 99.5),
    )
    found = dangerous_driving(frame, monitors(("m", "r", 60, "x")))
    assert rows(found, *COLUMNS) == [
        ("a", 0, 80.0, 60.0, 2),
        ("a", 0, 80.0, 60.0, 3),
        ("a", 20_000, 90.0, 60.0, 2),
    ]
    (two,) = found.where("create_time = 20000").collect()
    assert two.msg == (
        "危险驾驶：a : 危险驾驶车辆：OutOfLimitSpeedInfo(a,m,r,90.0,60,20000) --"
        "危险驾驶车辆：OutOfLimitSpeedInfo(a,m,r,99.5,60,30000) --"
    )


@pytest.mark.parametrize("gap, matches", [(119_999, 1), (120_000, 0)])
def test_span_is_strict(passages, monitors, gap, matches):
    for start in (0, 16 * 120_000 - 5):
        frame = passages((start, "m", "c", "a", 99.0), (start + gap, "m", "c", "a", 99.0))
        assert dangerous_driving(frame, monitors()).count() == matches


def test_hot_car_over_many_blocks(passages, monitors, rows):
    rng = random.Random(5)
    events = sorted(
        (rng.choice(["hot", "hot", "b"]), rng.randrange(600), f"m{rng.randrange(3)}")
        for _ in range(150)
    )
    frame = passages(*[(t, m, "c", car, 99.0) for car, t, m in events])
    expected = []
    for i, (car, t, _) in enumerate(events):
        for j in range(i + 1, len(events)):
            if events[j][0] == car and events[j][1] - t < 10:
                expected.append((car, t, j - i + 1))
    found = dangerous_driving(frame, monitors(), span_ms=10)
    assert rows(found, "car", "create_time", "n_events") == sorted(expected, key=repr)
