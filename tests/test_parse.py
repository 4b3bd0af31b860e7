import pytest

from roadstream import schemas
from roadstream.operators import (
    parse_passages,
    parse_police_actions,
    parse_violations,
    quality_split,
)

GOOD = "1600127946000,8228,55993,京K46744,39.6,58,31"


@pytest.fixture
def lines(spark):
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")


def test_passage(lines):
    (row,) = parse_passages(lines(GOOD), strict=True).collect()
    assert tuple(row) == (1600127946000, "8228", "55993", "京K46744", 39.6, "58", "31")


def test_ids_stay_strings(lines):
    (row,) = parse_passages(lines("1,0007,00042,c,1,05,03")).collect()
    assert (row.monitor_id, row.camera_id, row.road_id) == ("0007", "00042", "05")


@pytest.mark.parametrize(
    "line, reason",
    [
        ("11,22,33,京P12345,57.2,0", "short"),
        ("", "empty"),
        (None, "empty"),
        ("x,1,2,c,1.0,5,3", "bad_number"),
        ("1,1,2,c,fast,5,3", "bad_number"),
        ("1.5,1,2,c,1.0,5,3", "bad_number"),
        (" 1,1,2,c,1.0,5,3", "bad_number"),
        ("9223372036854775808,1,2,c,1.0,5,3", "bad_number"),
        ("1,1,2,c,inf,5,3", "bad_number"),
        ("1,1,2,c,1.0,5,", "short"),
        (",,,,,,,", "short"),
    ],
)
def test_rejects(lines, line, reason):
    good, bad = quality_split(lines(line, GOOD))
    assert good.count() == 1
    assert [tuple(r) for r in bad.collect()] == [(line, reason)]


@pytest.mark.parametrize(
    "line", [GOOD + ",more", "1,,2,c, 1e1 ,5,3", "+1,1,2,c,NaN,5,3", "1,1,2,c,1,5,,x"]
)
def test_accepts(lines, line):
    good, bad = quality_split(lines(line))
    assert (good.count(), bad.count()) == (1, 0)


def test_strict_fails_on_a_bad_line(lines):
    with pytest.raises(Exception, match="short: 1,2"):
        parse_passages(lines(GOOD, "1,2"), strict=True).collect()


def test_other_records(lines):
    (action,) = parse_police_actions(
        lines("6389,皖M16450,罚款200元,1600165650000")
    ).collect()
    assert tuple(action) == ("6389", "皖M16450", "罚款200元", 1600165650000)
    (violation,) = parse_violations(
        lines("皖M16450,违章超速12次,1600165750000", "皖M16450,x")
    ).collect()
    assert tuple(violation) == ("皖M16450", "违章超速12次", 1600165750000)


def test_split_of_other_schema(lines):
    _, bad = quality_split(lines("a,b,c"), schemas.VIOLATION)
    assert bad.first().reason == "bad_number"
