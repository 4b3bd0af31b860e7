"""Every query against its SQL on the driver's tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import MEDIUM, SMALL
from roadstream.plans import lineage

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    def connect(folder):
        con = duckdb.connect()
        for path in glob.glob(f"{folder}/*.parquet"):
            name = os.path.basename(path).removesuffix(".parquet")
            con.execute(f"create view {name} as select * from '{path}'")
        return con

    return {folder: connect(folder) for folder in (SMALL, MEDIUM)}


def _table(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in values), key=repr
    )


# At the larger scale the queries whose rows depend on a car's or window's history.
STATEFUL = [
    "area_vehicle_count_running",
    "dangerous_driving",
    "police_match",
    "repeat_plate",
    "top_congested",
]


# Queries of the training-data subpackage are tested in tests/llm.
SQL = {k: v for k, v in SQL.items() if k != "pipeline" and not k.startswith("op")}


@pytest.mark.parametrize(
    "name, folder",
    [(name, SMALL) for name in sorted(SQL)] + [(name, MEDIUM) for name in STATEFUL],
)
def test_same_rows(spark, duck, name, folder):
    frame = contract.queries()[name](spark, folder)
    ours = _table(frame.columns, [tuple(r) for r in frame.collect()])
    result = duck[folder].execute(SQL[name])
    theirs = _table([c[0] for c in result.description], result.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) > 0
    assert ours[1] == theirs[1]


def test_every_query_has_sql():
    ours = {q for q in contract.queries() if q != "pipeline" and not q.startswith("op")}
    assert ours == set(SQL)


def test_monitors_grow_with_the_tables(spark):
    read = contract.queries()["read_monitors"]
    sizes = [(read(spark, f).count(), spark.read.parquet(f"{f}/part.parquet").count()) for f in (SMALL, MEDIUM)]
    assert sizes[0] == (sizes[0][1],) * 2 and sizes[1] == (sizes[1][1],) * 2
    assert sizes[1][0] > sizes[0][0]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(lineage, "shared_folder", lambda _: None)
    assert lineage.working_folder(spark).startswith("/")
    monkeypatch.setattr(spark.sparkContext, "master", "local-cluster[2,1,1024]")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lineage.working_folder(spark)


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == [
        "start_time",
        "end_time",
        "rank",
        "monitor_id",
        "car_count",
        "avg_speed",
    ]
    assert frame.count() > 0
