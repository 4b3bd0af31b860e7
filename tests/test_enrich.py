import math

from roadstream.operators import (
    car_track,
    lookup_track,
    overspeed,
    severe_overspeed,
    track_rows,
    watchlist_passages,
    with_speed_limits,
)

LIMIT = 60 * 1.1


def test_overspeed_boundaries(passages, monitors, rows):
    found = overspeed(
        passages(
            (1, "m1", "c", "at", LIMIT),
            (2, "m1", "c", "above", math.nextafter(LIMIT, 100), "own road"),
            (3, "unknown", "c", "x", 500.0),
            (4, "zero", "c", "x", 500.0),
        ),
        monitors(("m1", "monitor road", 60, "a"), ("zero", "r", 0, "a")),
    )
    assert rows(found) == [
        ("above", "m1", "own road", math.nextafter(LIMIT, 100), 60, 2)
    ]


def test_limits_by_default_and_zero(passages, monitors, rows):
    frame = passages(
        (1, "m1", "c", "a", 70.0, "own"),
        (2, "new", "c", "b", 72.1, "own"),
        (3, "zero", "c", "d", 0.1, "own"),
        (4, "new", "c", "e", 72.0, "own"),
    )
    dim = monitors(("m1", "mr", 80, "x"), ("zero", "zr", 0, "x"))
    limited = with_speed_limits(frame, dim)
    assert rows(limited, "car", "road_id", "limit_speed") == [
        ("a", "mr", 80),
        ("b", "own", 60),
        ("d", "zr", 0),
        ("e", "own", 60),
    ]
    assert rows(severe_overspeed(frame, dim), "car") == [("b",), ("d",)]


def test_doubled_dimension_rows_do_not_multiply(passages, monitors):
    dim = monitors(("m1", "a", 60, "x"), ("m1", "a", 60, "x"), ("m1", "a", 50, "x"))
    frame = passages((1, "m1", "c", "a", 100.0))
    assert overspeed(frame, dim).count() == 1
    assert with_speed_limits(frame, dim).count() == 1


def test_tracks(spark, passages, rows):
    watch = spark.createDataFrame(
        [("b", "x", 1), ("b", "y", 2)], "car string, violation string, create_time long"
    )
    frame = passages(
        (5, "m", "c", "a", 1.0), (7, "m", "c", "b", 2.0), (9, "n", "c", "b", 3.0)
    )
    tracks = track_rows(watchlist_passages(frame, watch))
    assert rows(tracks, "row_key", "action_time") == [
        ("row_b_9223372036854775798", 9),
        ("row_b_9223372036854775800", 7),
    ]
    assert [r.action_time for r in car_track(tracks, "b").collect()] == [9, 7]
    assert lookup_track(tracks, "row_b_9223372036854775798").first().speed == 3.0
