"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """Each node of ``edges`` (a, b) with the smallest node it can reach, as (node, label).

    Edges stay a distributed table throughout. A round writes the table once; the rounds
    grow with the logarithm of the longest chain.
    """
    forward = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    state = written(forward.distinct())
    seen = None
    while True:
        now = state.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == seen or now[0] == 0:
            break
        seen = now
        state = written(_small_star(_large_star(state)))
    stars = state.groupBy("a").agg(F.min("b").alias("label"))
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return stars.select(F.col("a").alias("node"), "label").unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node are linked with its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    up = both.where("b > a").join(least, "a")
    return up.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are linked with the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    below = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return below.unionByName(own).where("a <> b").distinct()
