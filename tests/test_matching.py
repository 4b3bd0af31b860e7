import random

import pytest

from roadstream import schemas
from roadstream.operators import police_interval_join, police_match


@pytest.fixture
def police(spark):
    def build(actions, violations):
        return (
            spark.createDataFrame(actions, schemas.POLICE_ACTION),
            spark.createDataFrame(violations, schemas.VIOLATION),
        )

    return build


def test_bounds_are_inclusive(police, rows):
    t = 100_000
    sides = police(
        [("p", "a", "s", t)],
        [("a", str(d), t + d) for d in (-5_001, -5_000, 0, 5_000, 5_001)],
    )
    found = police_interval_join(*sides)
    assert rows(found, "msg") == [("-5000",), ("0",), ("5000",)]


def test_kinds(police, rows):
    sides = police(
        [("p1", "a", "s", 1_000), ("p2", "b", "s", 1_000), ("p3", "c", "s", 1_000)],
        [("a", "v1", 2_000), ("a", "v2", 3_000), ("c", "v3", 9_000), ("d", "v4", 0)],
    )
    found = police_match(*sides)
    assert rows(found, "kind", "car", "police_id", "msg") == [
        ("action_only", "b", "p2", None),
        ("action_only", "c", "p3", None),
        ("matched", "a", "p1", "v1"),
        ("matched", "a", "p1", "v2"),
        ("violation_only", "c", None, "v3"),
        ("violation_only", "d", None, "v4"),
    ]


@pytest.mark.parametrize("tolerance", [0, 1, 5, 50])
def test_against_all_pairs_with_a_hot_car(police, rows, tolerance):
    rng = random.Random(tolerance)
    cars = ["hot", "hot", "b", "c"]
    actions = [(f"p{i}", rng.choice(cars), "s", rng.randrange(-300, 300)) for i in range(90)]
    violations = [(rng.choice(cars), f"v{i}", rng.randrange(-300, 300)) for i in range(90)]
    pairs = {
        (p[0], v[1])
        for p in actions
        for v in violations
        if p[1] == v[0] and abs(p[3] - v[2]) <= tolerance
    }
    expected = [("matched", p, v) for p, v in pairs]
    expected += [
        ("action_only", p[0], None) for p in actions if p[0] not in {x for x, _ in pairs}
    ]
    expected += [
        ("violation_only", None, v[1])
        for v in violations
        if v[1] not in {x for _, x in pairs}
    ]
    sides = police(actions, violations)
    found = police_match(*sides, tolerance_ms=tolerance)
    assert rows(found, "kind", "police_id", "msg") == sorted(expected, key=repr)
    joined = police_interval_join(*sides, tolerance_ms=tolerance)
    assert rows(joined, "police_id", "msg") == sorted(pairs, key=repr)
