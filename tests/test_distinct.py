import random

import pytest

from roadstream.operators import (
    area_vehicle_count,
    area_vehicle_count_bloom,
    area_vehicle_count_running,
)


def test_counts_cars_once_per_area_and_window(passages, rows):
    frame = passages(
        (0, "m", "c", "a", 1.0, "r", "x"),
        (9_999, "m", "c", "a", 1.0, "r", "x"),
        (5, "m", "c", "b", 1.0, "r", "x"),
        (10_000, "m", "c", "a", 1.0, "r", "x"),
        (5, "m", "c", "a", 1.0, "r", "y"),
    )
    expected = [("x", 0, 10_000, 2), ("x", 10_000, 20_000, 1), ("y", 0, 10_000, 1)]
    assert rows(area_vehicle_count(frame)) == expected
    assert rows(area_vehicle_count_bloom(frame)) == expected


def _running(records, size):
    seen, out = {}, []
    for time, camera, car, area in sorted(
        records, key=lambda r: (r[3], r[0], r[2], r[1])
    ):
        start = time - time % size
        cars = seen.setdefault((area, start), set())
        cars.add(car)
        out.append((area, start, start + size, time, car, camera, len(cars)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_ms", [None, 1, 7, 1000])
def test_running_count_with_a_hot_area_and_copies(spark, passages, rows, slice_ms):
    rng = random.Random(3)
    records = [
        (
            rng.randrange(400),
            f"c{rng.randrange(3)}",
            f"car{rng.choice([0, 0, 0, rng.randrange(40)])}",
            rng.choice(["hot", "hot", "x", "y"]),
        )
        for _ in range(400)
    ]
    records += [records[0]] * 150
    frame = passages(*[(t, "m", c, car, 1.0, "r", a) for t, c, car, a in records])
    found = area_vehicle_count_running(frame, size_ms=100, slice_ms=slice_ms)
    assert rows(found) == _running(records, 100)


def test_approximate_count_is_close(spark):
    frame = spark.range(20_000).selectExpr(
        "0L action_time", "cast(id as string) car", "'a' area_id"
    )
    (count,) = area_vehicle_count_bloom(frame).collect()
    assert abs(count.car_count - 20_000) < 1_000


def test_sketches_are_united_into_any_window(spark, passages):
    """Sketches of few cars are exact; windows slide over panes, areas are put together."""
    from roadstream.operators import area_vehicle_sketches, vehicle_count_of_sketches

    seen = [(t, f"car{t // 7 % 9}", f"a{t % 3}") for t in range(0, 400, 3)]
    frame = passages(*[(t, "m", "c", car, 1.0, "r", area) for t, car, area in seen])
    sketches = area_vehicle_sketches(frame, 10)
    for size, slide, by in ((40, 20, ("area_id",)), (30, 30, ()), (10, 10, ("area_id",))):
        got = {tuple(r) for r in vehicle_count_of_sketches(sketches, size, slide, by).collect()}
        want = {}
        for t, car, area in seen:
            for start in range((t - size) // slide * slide + slide, t + 1, slide):
                if start <= t < start + size:
                    key = (area, start, start + size) if by else (start, start + size)
                    want.setdefault(key, set()).add(car)
        assert got == {(*k, len(cars)) for k, cars in want.items()}


def test_large_sketches_are_near(spark):
    from pyspark.sql import functions as F
    from roadstream.operators import area_vehicle_sketches, vehicle_count_of_sketches
    from roadstream.operators.distinct import SKETCH_RSD

    frame = spark.range(60_000).select(
        (F.col("id") % 100).alias("action_time"), (F.col("id") % 20_000).cast("string").alias("car"), F.lit("a").alias("area_id")
    )
    sketches = area_vehicle_sketches(frame, 10)
    assert sketches.agg(F.max(F.length("sketch"))).first()[0] < 6000
    (row,) = vehicle_count_of_sketches(sketches, 100).collect()
    assert abs(row["car_count"] - 20_000) < 4 * SKETCH_RSD * 20_000
