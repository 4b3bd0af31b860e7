import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import SMALL
from roadstream import testmap
from roadstream.operators import (
    dangerous_pairs,
    overspeed,
    severe_overspeed,
    watchlist_passages,
    with_speed_limits,
)
from roadstream.plans import (
    cut_lineage,
    dimensions,
    fits_broadcast,
    fold_copies,
    in_blocks,
    join_dimension,
    one_per_key,
    unfold_copies,
)
from roadstream.streaming import jobs
from roadstream.streaming.patterns import dangerous_driving_stream


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_size_decides_on_broadcast(spark):
    dim = spark.range(1000).selectExpr("cast(id as string) k", "repeat('x', 1000) v")
    assert fits_broadcast(dim)
    assert not fits_broadcast(dim, 500_000)
    assert fits_broadcast(dim.where("false"), 0)
    assert not fits_broadcast(dim.select("k", F.array("v").alias("v")))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_large_dimension_gives_the_same_rows(spark, rows, how):
    # Half of the facts share one key.
    facts = spark.range(400).selectExpr("if(id % 2 = 0, 0, id) k", "id v")
    dim = spark.range(0, 300, 3).selectExpr("id k", "id * 2 w")
    small = join_dimension(facts, dim, "k", how)
    large = join_dimension(facts, dim, "k", how, max_bytes=0, salts=4)
    assert "BroadcastHashJoin" in plan(small)
    assert "_salt" in plan(large)
    assert small.columns == large.columns
    assert rows(small) == rows(large)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_copies_of_a_large_dimension_are_not_broadcast(spark, how):
    facts = spark.range(400).selectExpr("id % 7 k", "id v")
    dim = spark.range(0, 300, 3).selectExpr("id k", "id * 2 w")
    # Spark's own estimate of the copies is far below its threshold.
    assert "Broadcast" not in plan(join_dimension(facts, dim, "k", how, max_bytes=0))


LARGE = ["dangerous_driving", "severe_overspeed", "with_speed_limits", "overspeed"]


@pytest.mark.parametrize("name", LARGE)
def test_large_dimensions_are_never_broadcast(spark, monkeypatch, name):
    monkeypatch.setattr(dimensions, "fits_broadcast", lambda *a, **k: False)
    text = plan(contract.queries()[name](spark, SMALL))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def overspeed_batch(spark, folder):
    """The plan of the batch that the job writes."""
    seen = []
    jobs.overspeed_job(
        testmap.passages_stream(spark, SMALL),
        lambda: testmap.monitors(spark, SMALL),
        lambda batch, _: seen.append(plan(batch)),
        folder,
        available_now=True,
    ).awaitTermination()
    return "\n".join(seen)


def explained(frame):
    utils = frame.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return utils.explainString(frame._jdf.queryExecution(), "simple")


def severe_runs(spark, folder):
    passages, monitors = testmap.passages_stream(spark, SMALL), testmap.monitors(spark, SMALL)
    return explained(dangerous_driving_stream(passages, monitors))


def severe_pairs(spark, folder):
    passages, monitors = testmap.passages_stream(spark, SMALL), testmap.monitors(spark, SMALL)
    return explained(dangerous_pairs(severe_overspeed(passages, monitors)))


LARGE_ON_STREAMS = {
    "overspeed_stream": overspeed_batch,
    "dangerous_driving_stream": severe_runs,
    "dangerous_pairs_stream": severe_pairs,
}


@pytest.mark.parametrize("name", sorted(LARGE_ON_STREAMS))
def test_large_dimensions_are_never_broadcast_on_streams(spark, monkeypatch, tmp_path, name):
    monkeypatch.setattr(dimensions, "fits_broadcast", lambda *a, **k: False)
    text = LARGE_ON_STREAMS[name](spark, str(tmp_path))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_operators_beyond_the_broadcast_limit(spark, rows, monkeypatch):
    p = testmap.passages(spark, SMALL)
    m = testmap.monitors(spark, SMALL)
    watch = testmap.violation_list(spark, SMALL)

    def results():
        return [
            rows(overspeed(p, m)),
            rows(with_speed_limits(p, m)),
            rows(watchlist_passages(p, watch)),
        ]

    small = results()
    monkeypatch.setattr(dimensions, "fits_broadcast", lambda *a, **k: False)
    assert results() == small


def test_newest_row_of_a_key(spark, rows):
    dim = spark.createDataFrame(
        [("a", "old", 1), ("a", "new", 2), ("b", "x", 1)], "car string, why string, at long"
    )
    assert rows(one_per_key(dim, "car", "at")) == [("a", "new", 2), ("b", "x", 1)]


def test_blocks_hold_every_neighbour(spark, rows):
    frame = spark.createDataFrame([(t,) for t in (-1, 0, 9, 10, 12, 13, 19, 20)], "t long")
    blocks = in_blocks(frame, "t", 10, before_ms=1, after_ms=3)
    placed = {}
    for t, home, block in rows(blocks, "t", "_home", "_block"):
        assert home == t // 10
        placed.setdefault(block, []).append(t)
    assert sorted(placed[0]) == [-1, 0, 9, 10, 12]
    assert sorted(placed[1]) == [9, 10, 12, 13, 19, 20]


def test_copies_fold_and_unfold(spark, rows):
    frame = spark.createDataFrame([("a",)] * 3 + [("b",)], "k string")
    folded = fold_copies(frame, "k")
    assert rows(folded) == [("a", 3), ("b", 1)]
    assert rows(unfold_copies(folded)) == [("a",), ("a",), ("a",), ("b",)]
    large = spark.createDataFrame(
        [("a", 2_000_001), ("b", 0), ("c", 1_000_000)], "k string, _copies long"
    )
    counts = unfold_copies(large).groupBy("k").count()
    assert rows(counts) == [("a", 2_000_001), ("c", 1_000_000)]


def test_lineage_is_cut_in_the_shared_folder(spark):
    frame = spark.range(5).selectExpr("id * 2 v")
    assert "Range" not in plan(cut_lineage(frame))
    assert cut_lineage(frame).count() == 5


@pytest.mark.parametrize("name", ["overspeed", "track_rows", "watchlist_passages"])
def test_passages_are_not_shuffled_for_small_dimensions(spark, name):
    text = plan(contract.queries()[name](spark, SMALL))
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(contract.queries()["police_interval_join"](spark, SMALL))
    assert "EqualTo(event_type,purchase)" in text
    assert "EqualTo(event_type,error)" in text
    scan = plan(contract.queries()["area_vehicle_count"](spark, SMALL))
    (schema,) = [line for line in scan.splitlines() if "ReadSchema" in line]
    assert "props" not in schema.split("ReadSchema")[1]


NATIVE = [
    name
    for name in sorted(contract.queries())
    if not name.startswith(("repeat_plate", "op", "pipeline")) and not name.endswith("_stream")
]


@pytest.mark.parametrize("name", NATIVE)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(contract.queries()[name](spark, SMALL))
    for word in ("Cartesian", "NestedLoop", "Python", "Arrow"):
        assert word not in text


def test_pattern_is_shuffled_and_sorted_once(spark):
    frame = contract.queries()["dangerous_driving"](spark, SMALL)
    text = plan(frame).split("BroadcastHashJoin")[0]
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1


def test_cars_of_an_area_are_never_in_one_group(spark):
    text = plan(contract.queries()["area_vehicle_count"](spark, SMALL))
    # The distinct is shuffled by area, window and car; only counts meet by area.
    assert text.count("Exchange hashpartitioning(area_id") == 2
    assert "collect" not in text
