"""Running vehicle counts on a stream, one for every passage.

The state lies in tables between batches: passages that the watermark has not passed yet, the
cars seen in windows that are open, and these windows' counts. A batch settles what its
watermark has passed, as a plain batch query: cars that are new in a window are found by an
anti join, and a busy area's window is ordered in slices.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.constants import AREA_WINDOW_MS
from roadstream.functions.timing import floor_to
from roadstream.operators.distinct import running_counts
from roadstream.plans import files
from roadstream.streaming.sinks import Sink
from roadstream.streaming.store import merge_by_key, read_merged

DELAY_MS = 5_000
_PASSAGE = "area_id string, action_time bigint, car string, camera_id string"
_COUNT = "area_id string, start_time bigint, car_count bigint"
_WINDOW = ["area_id", "start_time"]


def counts_sink(path: str, state: str, size_ms: int = AREA_WINDOW_MS, delay_ms: int = DELAY_MS) -> Sink:
    """Append to ``path`` the running count of every passage that the watermark has passed.

    The watermark is the latest time so far less ``delay_ms``; a passage that is behind the one
    of the batch before is late and left out. A replayed batch begins with the state after its
    predecessor and replaces what it wrote. The state is as large as the open windows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _State(spark, state, batch_id - 1)
        fresh = batch.select("area_id", "action_time", "car", "camera_id")
        if before.mark is not None:
            fresh = fresh.where(F.col("action_time") > before.mark)
        rows = fresh.unionByName(before.waiting).where("action_time is not null").persist()
        try:
            newest = rows.agg(F.max("action_time")).first()[0]
            times = [t for t in (newest, before.newest) if t is not None]
            mark = max(times) - delay_ms if times else None
            settled = rows.where(F.col("action_time") <= F.lit(mark).cast("bigint"))
            start = floor_to(F.col("action_time"), size_ms).alias("start_time")
            firsts = settled.groupBy("area_id", start, "car").agg(F.min("action_time").alias("action_time"))
            new = _unseen(firsts, before.seen())
            counts = running_counts(settled, new, before.counts, size_ms)
            counts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            # What a later passage can still fall into.
            is_open = F.col("start_time") + size_ms > F.lit(mark).cast("bigint") + 1
            merge_by_key(f"{state}/seen", *_WINDOW, "car", keep=is_open)(new.select(*_WINDOW, "car"), batch_id)
            added = new.groupBy(*_WINDOW).agg(F.count(F.lit(1)).alias("car_count"))
            after = added.unionByName(before.counts).groupBy(*_WINDOW).agg(F.sum("car_count").alias("car_count"))
            after.where(is_open).write.mode("overwrite").parquet(f"{state}/counts/after_batch={batch_id}")
            waiting = rows.where(F.col("action_time") > F.lit(mark).cast("bigint"))
            waiting.write.mode("overwrite").parquet(f"{state}/waiting/after_batch={batch_id}")
            files.write_text(spark, f"{state}/after/{batch_id}.json", json.dumps({"mark": mark, "newest": max(times, default=None)}))
            for table in ("counts", "waiting"):
                # The state before is needed again if this batch is; those before it are not.
                files.remove(spark, f"{state}/{table}/after_batch={batch_id - 2}")
        finally:
            rows.unpersist()

    return write


class _State:
    """The tables after a batch; empty ones before the first."""

    def __init__(self, spark: SparkSession, state: str, batch_id: int) -> None:
        self.spark, self.path, self.batch_id = spark, state, batch_id
        known = {"mark": None, "newest": None}
        if batch_id >= 0:
            known = json.loads(files.read_text(spark, f"{state}/after/{batch_id}.json"))
        self.mark, self.newest = known["mark"], known["newest"]
        self.waiting = self._table("waiting", _PASSAGE)
        self.counts = self._table("counts", _COUNT)

    def _table(self, name: str, schema: str) -> DataFrame:
        if self.batch_id < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}/after_batch={self.batch_id}")

    def seen(self) -> DataFrame | None:
        return read_merged(self.spark, f"{self.path}/seen", self.batch_id) if self.batch_id >= 0 else None


def _unseen(firsts: DataFrame, seen: DataFrame | None) -> DataFrame:
    if seen is None:
        return firsts
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (*_WINDOW, "car")]
    return firsts.alias("f").join(seen.alias("s"), same, "left_anti")
