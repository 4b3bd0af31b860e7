import pytest

from roadstream.operators import (
    average_speed,
    average_speed_2dp,
    rank_congested,
    top_congested,
    top_congested_report,
)

MIN = 60_000


def test_edge_belongs_to_the_window_it_starts(passages, rows):
    windows = rows(
        average_speed(passages((10 * MIN, "m", "c", "a", 50.0))), "start_time", "end_time"
    )
    assert windows == sorted(
        (((10 - i) * MIN, (15 - i) * MIN) for i in range(5)), key=repr
    )


def test_average_counts_passages(passages, rows):
    frame = passages(
        (0, "m", "c", "a", 10.1), (1, "m", "c", "a", 10.2), (2, "m", "c", "b", 10.3)
    )
    found = average_speed(frame, 1000, 1000)
    assert rows(found) == [(0, 1000, "m", 10.2, 3)]


def test_times_before_the_epoch(passages, rows):
    found = average_speed(passages((-1, "m", "c", "a", 8.0)), 10, 5)
    assert rows(found, "start_time", "end_time") == [(-10, 0), (-5, 5)]


def test_slide_wider_than_size(passages, rows):
    frame = passages((1, "m", "c", "a", 8.0), (7, "m", "c", "a", 8.0))
    assert rows(average_speed(frame, 5, 10), "start_time", "car_count") == [(0, 1)]


def test_two_decimals_round_half_up(passages, rows):
    frame = passages((0, "m", "c", "a", 2.67), (1, "m", "c", "a", 2.68))
    assert rows(average_speed_2dp(frame, 1000, 1000), "avg_speed") == [(2.68,)]
    frame = passages((0, "m", "c", "a", -2.67), (1, "m", "c", "a", -2.68))
    assert rows(average_speed_2dp(frame, 1000, 1000), "avg_speed") == [(-2.68,)]


def test_top_three_and_ties(passages, rows):
    frame = passages(
        *[(i, "m3", "c", "a", 1.0) for i in range(3)],
        *[(i, "m2", "c", "a", 1.0) for i in range(2)],
        (0, "m9", "c", "a", 1.0),
        (0, "m1", "c", "a", 1.0),
    )
    top = top_congested(frame, size_ms=1000, slide_ms=1000)
    assert rows(top, "rank", "monitor_id", "car_count") == [
        (1, "m3", 3),
        (2, "m2", 2),
        (3, "m1", 1),
    ]
    (report,) = top_congested_report(top).collect()
    assert report.report == (
        "在窗口‘0---1000’时间范围内，整个城市最堵的前3卡口是：\n\r"
        "卡口：m3，经过的车辆数量：3,平均车速：1.0 \n\r"
        "卡口：m2，经过的车辆数量：2,平均车速：1.0 \n\r"
        "卡口：m1，经过的车辆数量：1,平均车速：1.0 \n\r"
    )


def test_rank_is_limited_before_the_shuffle(spark):
    averages = spark.createDataFrame(
        [(0, 1, "m", 1.0, 1)],
        "start_time long, end_time long, monitor_id string, avg_speed double, car_count long",
    )
    plan = rank_congested(averages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "speeds, mean",
    [
        ([1e-7, 1e-7], 1e-7),
        ([1e13, 3e13], 2e13),
        ([float("inf"), 5.0], float("inf")),
        ([float("nan"), 5.0], float("nan")),
        ([float("inf"), float("-inf")], float("nan")),
        ([0.1, 0.2, 0.3], 0.2),
        ([1e-7, 40.25], 20.12500005),
    ],
)
def test_speeds_beyond_the_ordinary(passages, speeds, mean):
    frame = passages(*[(i, "m", "c", "x", v) for i, v in enumerate(speeds)])
    exact = average_speed(frame, 100, 100).first()["avg_speed"]
    rounded = average_speed_2dp(frame, 100, 100).first()["avg_speed"]
    assert exact == pytest.approx(mean, rel=1e-12, abs=0, nan_ok=True)
    assert rounded == pytest.approx(mean if abs(mean) > 1e9 or mean != mean else round(mean + 1e-12, 2), nan_ok=True)
    assert top_congested(frame, 1, 100, 100).count() == 1
