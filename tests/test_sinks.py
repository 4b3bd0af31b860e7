import pytest

import __spark_entry__ as contract
from conftest import SMALL
from roadstream import schemas, testmap
from roadstream.sources import lines as line_sources
from roadstream.sources import tables
from roadstream.streaming import sinks

WARNING = (
    "car string, first_camera_id string, second_camera_id string, msg string, "
    "create_time long"
)
DAY = 86_400_000


def test_replayed_batch_is_stored_once(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.append_table(path)
    write(spark.createDataFrame([(1,)], "v int"), 0)
    for _ in range(2):
        write(spark.createDataFrame([(2,), (3,)], "v int"), 1)
    assert rows(sinks.read_appended(spark, path)) == [(1,), (2,), (3,)]


def test_days_are_folders(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.append_table(path, "at")
    write(spark.createDataFrame([(1,), (DAY,)], "at long"), 0)
    for _ in range(2):
        write(spark.createDataFrame([(2,)], "at long"), 1)
    table = sinks.read_appended(spark, path)
    assert rows(table, "at") == [(1,), (2,), (DAY,)]
    second = table.where("day = date'1970-01-02'")
    assert rows(second, "at") == [(DAY,)]
    (scan,) = [
        line
        for line in second._jdf.queryExecution().executedPlan().toString().splitlines()
        if "PartitionFilters" in line
    ]
    assert "day" in scan.split("PartitionFilters")[1].split("]")[0]


def test_insert_if_absent(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.insert_if_absent(path)

    def warnings(*values):
        return spark.createDataFrame([(c, "1", "2", "m", t) for c, t in values], WARNING)

    write(warnings(), 0)
    write(warnings(("a", 5), ("a", 3), ("b", 7)), 1)
    second = warnings(("a", 2), ("a", DAY), ("c", 1))
    for _ in range(2):
        write(second, 2)
    stored = spark.read.parquet(path)
    expected = [("a", 3), ("a", DAY), ("b", 7), ("c", 1)]
    assert rows(stored, "car", "create_time") == expected
    # Replaying the first batch does not see the second one.
    write(warnings(("a", 5), ("a", 3), ("b", 7)), 1)
    assert rows(spark.read.parquet(path), "car", "create_time") == expected


def test_later_batch_replaces_the_row_of_a_key(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.upsert_by_key(path)
    write(spark.createDataFrame([("a", 9), ("b", 1)], "k string, n int"), 0)
    for _ in range(2):
        write(spark.createDataFrame([("a", 2)], "k string, n int"), 1)
    assert rows(sinks.read_latest(spark, path, "k")) == [("a", 2), ("b", 1)]


def test_lookup_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_by_key(path)(spark.createDataFrame([("a", 9)], "row_key string, n int"), 0)
    found = sinks.read_latest(spark, path, "row_key").where("row_key = 'a'")
    assert "EqualTo(row_key,a)" in found._jdf.queryExecution().executedPlan().toString()
    assert found.first().n == 9


def test_checkpoint_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert sinks.checkpoint_folder(spark, "job") == f"{shared}/streams/job"


class Recorder:
    """Stands in for a reader whose connector or database is not at hand."""

    def __init__(self):
        self.calls = []
        self.readStream = self.read = self

    def format(self, name):
        self.calls.append(("format", name))
        return self

    def option(self, key, value):
        self.calls.append((key, value))
        return self

    def options(self, **options):
        self.calls += list(options.items())
        return self

    def load(self):
        return self

    def selectExpr(self, expr):
        self.calls.append(("select", expr))
        return self


def test_kafka_starts_at_the_earliest_offset():
    session = Recorder()
    line_sources.read_kafka_lines(session, "host:9092", "t_traffic", maxOffsetsPerTrigger=5)
    assert session.calls == [
        ("format", "kafka"),
        ("kafka.bootstrap.servers", "host:9092"),
        ("subscribe", "t_traffic"),
        ("startingOffsets", "earliest"),
        ("maxOffsetsPerTrigger", 5),
        ("select", "cast(value as string) as value"),
    ]


@pytest.mark.parametrize("read, table", [
    (tables.read_monitors, "t_monitor_info"),
    (tables.read_violation_list, "t_violation_list"),
])
def test_database_tables(read, table):
    session = Recorder()
    read(session, "jdbc:x", {"user": "u"})
    assert ("format", "jdbc") in session.calls and ("user", "u") in session.calls
    assert f"from {table}) t" in dict(session.calls)["dbtable"]


@pytest.mark.parametrize("query, schema", [
    ("overspeed", schemas.OVERSPEED),
    ("average_speed", schemas.AVERAGE_SPEED),
    ("dangerous_driving", schemas.DANGEROUS_DRIVING),
    ("track_rows", schemas.TRACK),
])
def test_operators_fit_their_tables(spark, query, schema):
    frame = contract.queries()[query](spark, SMALL)
    kinds = dict(frame.dtypes)
    table = sinks.as_table(frame, schema)
    assert dict(table.dtypes) == {c: kinds[c] for c in table.columns}
    assert table.columns == schema.fieldNames()


def test_stored_warnings_call_the_cameras_monitors(spark, rows):
    warnings = spark.createDataFrame([("a", "c1", "c2", "m", 5)], WARNING)
    table = sinks.repeat_car_table(warnings)
    assert table.columns == schemas.REPEAT_CAR.fieldNames()
    assert rows(table) == [("a", "c1", "c2", "m", 5)]


def test_a_table_without_batches_is_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    assert sinks.read_appended(spark, path, schemas.PASSAGE).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sinks.read_appended(spark, path)


def test_console_takes_the_rows(spark):
    query = sinks.console(testmap.passages_stream(spark, SMALL).select("car"))
    query.processAllAvailable()
    seen = sum(p["numInputRows"] for p in query.recentProgress)
    query.stop()
    assert "Console" in query.lastProgress["sink"]["description"]
    assert seen == testmap.passages(spark, SMALL).count()


def test_kinds_are_tables_written_in_one_pass(spark, rows, tmp_path):
    from roadstream.operators import classified, quality_split
    from roadstream.operators.parse import KINDS
    from pyspark.sql import functions as F

    path, counts = str(tmp_path / "t"), {}
    lines = spark.createDataFrame(
        [("1,m,c,car,2.5,r,a",), ("1,m",), ("",), (None,), ("x,m,c,car,2.5,r,a",), ("2,m,c,car,9,r,a,more",)], "value string"
    )
    read = spark.sparkContext.accumulator(0)

    def seen(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    write = sinks.split_by_kind(path, KINDS, lambda batch, found: counts.update({batch: found}))
    for _ in range(2):
        read.value = 0
        write(classified(lines.mapInPandas(seen, "value string")), 0)
        assert read.value == 6  # one scan writes all tables and counts them
    assert counts == {0: {"ok": 2, "empty": 2, "short": 1, "bad_number": 1}}
    good, rejects = quality_split(lines)
    assert rows(sinks.read_kind(spark, path, "ok").select(*good.columns)) == rows(good)
    for kind in KINDS[1:]:
        assert sinks.read_kind(spark, path, kind).count() == counts[0][kind]
        assert rows(sinks.read_kind(spark, path, kind).select("value")) == rows(rejects.where(F.col("reason") == kind).select("value"))


def test_insert_if_absent_lists_its_own_days(spark, rows, tmp_path):
    """Files of other days are not opened: here they could not be read."""
    path = str(tmp_path / "t")
    write = sinks.insert_if_absent(path)

    def warnings(*values):
        return spark.createDataFrame([(c, "1", "2", "m", t) for c, t in values], WARNING)

    write(warnings(("a", 5)), 0)
    write(warnings(("a", DAY), ("b", DAY)), 1)
    for file in (tmp_path / "t" / "day=1970-01-01").rglob("*.parquet"):
        file.write_bytes(b"broken")
    write(warnings(("a", DAY + 1), ("c", DAY + 2)), 2)
    assert rows(spark.read.parquet(f"{path}/day=1970-01-02").select("car")) == [("a",), ("b",), ("c",)]
