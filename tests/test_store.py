"""The table that keeps one row a key, and the table of tracks ordered by key."""

import random

import pytest

from roadstream import schemas
from roadstream.functions.keys import track_key
from roadstream.plans import files
from roadstream.sources import tracks
from roadstream.streaming import store
from pyspark.sql import functions as F

SCHEMA = "k string, g long, n int"


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    write = store.merge_by_key(path, "k", "g", buckets=3, runs=2)

    class Table:
        newest = {}

        def put(self, batch_id, *rows):
            write(spark.createDataFrame(rows, SCHEMA), batch_id)
            return self

    t = Table()
    t.path = path
    return t


def test_later_batches_replace_rows(spark, table, rows):
    table.put(0, ("a", 1, 9), ("b", 1, 1), ("b", None, 5)).put(1, ("a", 1, 2), ("c", 2, None)).put(2)
    assert rows(store.read_merged(spark, table.path)) == sorted([("a", 1, 2), ("b", 1, 1), ("b", None, 5), ("c", 2, None)], key=repr)
    # Within a batch the largest row of a key counts.
    table.put(3, ("c", 2, 4), ("c", 2, 7), (None, 1, 1))
    assert rows(store.read_key(spark, table.path, "c", 2)) == [("c", 2, 7)]
    assert rows(store.read_key(spark, table.path, None, 1)) == [(None, 1, 1)]
    assert rows(store.read_key(spark, table.path, "zz", 2)) == []


def test_many_batches_stay_few_runs(spark, tmp_path, rows):
    """Runs are merged, old ones removed, and the bytes that are read stay flat."""
    path = str(tmp_path / "t")
    write = store.merge_by_key(path, "k", buckets=2, runs=3)
    rng, want, read = random.Random(1), {}, []
    for batch in range(50):
        found = {f"k{rng.randrange(200)}": batch * 1000 + i for i in range(40)}
        want |= found
        write(spark.createDataFrame(list(found.items()), "k string, n int").coalesce(1), batch)
        manifest = store._manifest(spark, path)
        sizes = [[s for _, s in runs] for runs in manifest["buckets"].values()]
        assert all(len(s) <= 3 + 4 for s in sizes)
        read.append(sum(map(sum, sizes)))
    assert rows(store.read_merged(spark, path)) == sorted(want.items(), key=repr)
    # Runs come and go, but what is read does not grow with the number of batches.
    assert max(read[30:]) < 1.2 * max(read[10:30])
    # The folder holds what the last two manifests name and no more.
    assert files.size(spark, f"{path}/runs") < 4 * read[-1] + 50_000
    assert len(files.names(spark, f"{path}/manifests")) <= 2 * 2  # each with a checksum file


def test_a_replayed_batch_changes_nothing(spark, table, rows):
    for batch in range(6):
        table.put(batch, ("a", 1, batch), (f"x{batch}", 0, batch))
    before = rows(store.read_merged(spark, table.path))
    table.put(5, ("a", 1, 5), ("x5", 0, 5)).put(5, ("a", 1, 5), ("x5", 0, 5))
    assert rows(store.read_merged(spark, table.path)) == before and len(before) == 7
    table.put(6, ("a", 1, -1))
    assert rows(store.read_key(spark, table.path, "a", 1)) == [("a", 1, -1)]


def test_a_batch_that_failed_midway_is_done_again(spark, table, rows, monkeypatch):
    table.put(0, ("a", 1, 0))
    put = files.write_text
    monkeypatch.setattr(files, "write_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        table.put(1, ("a", 1, 1), ("b", 1, 1))
    assert rows(store.read_merged(spark, table.path)) == [("a", 1, 0)]
    monkeypatch.setattr(files, "write_text", put)
    table.put(1, ("a", 1, 1), ("b", 1, 1))
    assert rows(store.read_merged(spark, table.path)) == [("a", 1, 1), ("b", 1, 1)]


def test_only_touched_buckets_are_written(spark, table):
    table.put(0, *[(f"k{i}", i, i) for i in range(50)])
    before = store._manifest(spark, table.path)["buckets"]
    table.put(1, ("k1", 1, 0))
    after = store._manifest(spark, table.path)["buckets"]
    assert sum(before[b] != after[b] for b in after) == 1


def test_which_runs_are_merged():
    assert store.to_merge([100, 1], 4) == 0
    assert store.to_merge([1000, 1, 1, 1, 1], 4) == 4
    assert store.to_merge([6, 1, 1, 1, 1], 4) == 5
    assert store.to_merge([1000, 8, 1, 1, 1, 1], 4) == 5


def test_another_number_of_buckets_is_refused(spark, table):
    table.put(0, ("a", 1, 0))
    with pytest.raises(ValueError, match="3 buckets"):
        store.merge_by_key(table.path, "k", "g", buckets=4)(spark.createDataFrame([("a", 1, 1)], SCHEMA), 1)
    with pytest.raises(ValueError, match="no batch"):
        store.read_merged(spark, table.path + "x")


# --- tracks ------------------------------------------------------------------------------


@pytest.fixture
def stored(spark, tmp_path):
    rng = random.Random(2)
    seen = [(f"car{i % 40}", 1_700_000_000_000 + i * 1000 + rng.randrange(900), f"m{i}", "r", float(i)) for i in range(4000)]
    seen += [("hot", 1_600_000_000_000 + i, "m", "r", 1.0) for i in range(4000)] + [("a_b", 5, "m", "r", 1.0), ("a", 7, "m", "r", 2.0)]
    seen.append((None, 9, "m", "r", 3.0))
    frame = spark.createDataFrame(seen, "car string, action_time long, monitor_id string, road_id string, speed double")
    rows = frame.select(track_key(F.col("car"), F.col("action_time")).alias("row_key"), *frame.columns).select(schemas.TRACK.names)
    path = str(tmp_path / "tracks")
    tracks.store_tracks(rows, path, files=16)
    return path, rows


def test_a_point_read_opens_one_file(spark, stored, rows):
    path, all_rows = stored
    assert len(spark.read.parquet(f"{path}/rows").inputFiles()) == 16
    for key in [r["row_key"] for r in all_rows.where("car in ('hot', 'car7')").limit(20).collect()]:
        found = tracks.stored_row(spark, path, key)
        assert len(found.inputFiles()) == 1
        assert "EqualTo(row_key," in found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == rows(all_rows.where(F.col("row_key") == key))
    assert tracks.stored_row(spark, path, "row_zzz_1").collect() == []
    assert tracks.stored_row(spark, path, "a").collect() == []


def test_a_track_opens_its_own_files(spark, stored):
    path, all_rows = stored
    found = tracks.stored_track(spark, path, "car7")
    assert len(found.inputFiles()) <= 2
    want = [tuple(r) for r in all_rows.where("car = 'car7'").orderBy(F.desc("action_time")).collect()]
    assert [tuple(r) for r in found.collect()] == want and len(want) == 100
    # A hot car's rows are in several files.
    hot = tracks.stored_track(spark, path, "hot")
    assert 4 <= len(hot.inputFiles()) < 16 and hot.count() == 4000
    # A name that another one begins with.
    assert [r["action_time"] for r in tracks.stored_track(spark, path, "a").collect()] == [7]
    assert tracks.stored_track(spark, path, "nobody").collect() == []


def test_no_tracks(spark, stored, tmp_path):
    _, all_rows = stored
    tracks.store_tracks(all_rows.limit(0), str(tmp_path / "none"))
    assert tracks.stored_track(spark, str(tmp_path / "none"), "a").collect() == []
