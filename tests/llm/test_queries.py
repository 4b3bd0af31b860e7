"""The registered queries over the driver's tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from roadstream.llm import queries as Q

SMALL = "/root/testdata/sf0.001"


def test_a_query_for_each_operator():
    names = {n.split("_")[0] for n in Q.queries()}
    assert names == {f"op{i}" for i in range(1, 14)}
    assert {*Q.queries(), "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")
    result = con.execute(Q.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    theirs = sorted(result.fetchall(), key=repr)
    ours = sorted(map(tuple, Q.queries()[name](spark, SMALL).select(columns).collect()), key=repr)
    assert ours == theirs


def test_shards_of_all_documents(spark):
    rows = Q.queries()["op4_sharding"](spark, "/root/testdata/sf0.01").collect()
    sizes = [0] * 40
    for r in rows:
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes) / 40
    assert len(rows) == 1000 and max(sizes) < 1.1 * mean and min(sizes) > 0.9 * mean
