import random

import numpy as np
import pytest

from roadstream.functions.anchors import anchor_steps, fold_anchor
from roadstream.operators import repeat_plate, repeat_plate_daily, repeats
from roadstream.operators.repeats import _anchors, _crowded

OUT = ("car", "first_camera_id", "second_camera_id", "create_time")


def fold(records, gap):
    """The rule itself, one passage after the other."""
    anchors, out = {}, []
    for car, time, camera in sorted(records):
        at = anchors.get(car)
        if at is not None and time - at[0] < gap:
            pair = (at[1], camera) if time > at[0] else (camera, at[1])
            out.append((car, *pair, time))
        else:
            anchors[car] = (time, camera)
    return sorted(out, key=repr)


@pytest.fixture
def check(passages, rows):
    def run(records, gap=10_000):
        frame = passages(*[(t, "m", c, car, 1.0) for car, t, c in records])
        assert rows(repeat_plate(frame, gap), *OUT) == fold(records, gap)

    return run


@pytest.mark.parametrize("gap, hits", [(9_999, 1), (10_000, 0)])
def test_gap_is_strict(passages, gap, hits):
    frame = passages((0, "m", "c1", "a", 1.0), (gap, "m", "c2", "a", 1.0))
    assert repeat_plate(frame).count() == hits


def test_hit_keeps_the_anchor(passages, rows):
    frame = passages(*[(t, "m", f"c{t}", "a", 1.0) for t in (0, 6_000, 12_000)])
    assert rows(repeat_plate(frame), *OUT) == [("a", "c0", "c6000", 6_000)]
    assert repeat_plate(frame).first().msg == "存在套牌嫌疑"


def test_equal_times_name_the_current_passage_first(passages, rows):
    frame = passages((5, "m", "x", "a", 1.0), (5, "m", "y", "a", 1.0))
    assert rows(repeat_plate(frame), *OUT) == [("a", "y", "x", 5)]


def test_same_camera_and_copies_count(passages, rows):
    frame = passages(*[(5, "m", "x", "a", 1.0)] * 3, (9, "m", "x", "a", 1.0))
    assert rows(repeat_plate(frame), *OUT) == [
        ("a", "x", "x", 5),
        ("a", "x", "x", 5),
        ("a", "x", "x", 9),
    ]


@pytest.mark.parametrize("seed", range(4))
def test_random_histories(check, seed):
    """A hot car whose passages never pause, so that every block of it is open."""
    rng = random.Random(seed)
    gap = rng.choice([7, 20])
    records = [("hot", t, f"c{rng.randrange(4)}") for t in range(-500, 4_000, 3)]
    records += [("hot2", t + rng.randrange(2), "c") for t in range(0, 4_000, gap // 2)]
    records += [
        (f"car{rng.randrange(30)}", rng.randrange(3_000), f"c{rng.randrange(4)}")
        for _ in range(400)
    ]
    records += [records[10]] * 100
    check(records, gap)


def test_without_a_shared_folder(check, monkeypatch):
    monkeypatch.setattr(repeats, "cut_lineage", lambda frame: frame)
    rng = random.Random(11)
    check([(f"car{rng.randrange(3)}", rng.randrange(2_000), "c") for _ in range(500)], 9)


def test_interleaved_chains_do_not_merge(check):
    """Passages half a gap apart: the two possible chains stay apart for ever."""
    check([("a", 5 * i, f"c{i}") for i in range(1_000)], gap=10)


def test_open_block_is_crossed_without_anchor(check):
    # The second block has one passage, near the first block's late anchor.
    gap, block = 10, 640
    check([("a", block - 2, "x"), ("a", block + 3, "y"), ("a", block + 9, "z")], gap)


def test_nothing_crowded(passages):
    frame = passages((0, "m", "c", "a", 1.0), (50_000, "m", "c", "a", 1.0))
    assert repeat_plate(frame).count() == 0


def test_one_anchor_for_a_short_segment(passages):
    frame = passages(*[(t, "m", "c", "a", 1.0) for t in (0, 1, 2)])
    crowded = _crowded(frame, 10_000)
    assert crowded.where("_opens").count() == 1
    assert [r._anchor for r in _anchors(crowded, 10_000).collect()] == [0]


def test_steps():
    times = np.array([100, 104, 108, 113, 130])
    upto, last = anchor_steps(times, 10)
    for incoming in range(85, 100):
        expected, at = incoming, incoming
        for t in times:
            if t - at >= 10:
                at = int(t)
        expected = at
        place = int(np.searchsorted(upto, incoming + 10))
        assert int(last[place]) == expected


def test_fold_takes_distance_both_ways():
    hits, owners, at = fold_anchor(np.array([0, 95, 100, 104, 111]), 101, 10)
    # 0 becomes the anchor although it is older, then 95.
    assert at == 4
    assert hits.tolist() == [2, 3]
    assert owners.tolist() == [1, 1]


def test_first_warning_per_day(spark, rows):
    warnings = spark.createDataFrame(
        [
            ("a", "1", "2", "m", 5),
            ("a", "1", "3", "m", 4),
            ("a", "1", "4", "m", 86_400_000),
            ("b", "1", "5", "m", 86_399_999),
        ],
        "car string, first_camera_id string, second_camera_id string, msg string, "
        "create_time long",
    )
    daily = repeat_plate_daily(warnings)
    assert rows(daily, "car", "second_camera_id", "create_time") == [
        ("a", "3", 4),
        ("a", "4", 86_400_000),
        ("b", "5", 86_399_999),
    ]
    # In Shanghai the day begins eight hours earlier.
    local = repeat_plate_daily(warnings, "Asia/Shanghai")
    assert rows(local, "car", "create_time", "day")[1][2].isoformat() == "1970-01-02"
