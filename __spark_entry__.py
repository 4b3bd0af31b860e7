"""

The driver's generic tables are mapped to passages, monitors, police actions, violations
and a violation list by ``roadstream.testmap``; ``_VIEWS`` is the same mapping in SQL.
The events are sparse, so the queries use wider windows than the library's defaults.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream import operators as ops
from roadstream import testmap
from roadstream.functions.timing import floor_to
from roadstream.operators.distinct import SKETCH_RSD
from roadstream.operators.parse import KINDS
from roadstream.plans import working_folder
from roadstream.sources import follow_log_lines, read_log_lines, tables
from roadstream.sources.tracks import store_tracks, stored_row, stored_track
from roadstream.streaming import jobs, sinks, store
from roadstream.streaming.patterns import dangerous_driving_stream
from roadstream.streaming.repeats import repeat_plate_stream

HOUR = 3_600_000
DAY = 24 * HOUR
AVG_SIZE, AVG_SLIDE, TOP_SLIDE = 5 * HOUR, HOUR, 2 * HOUR
GAP = HOUR // 2
TOLERANCE = 6 * HOUR
CAR = "3"

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the most congested monitors of every sliding window."""
    return queries()["top_congested"](spark, SMOKE_DIR)


# --- queries ---------------------------------------------------------------------------


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return _as_lines(testmap.passages(spark, sf))


def _as_lines(p: DataFrame) -> DataFrame:
    """Passages as text lines: clicks lose their last two fields, errors their speed,
    sign-ups carry a field more."""
    kind = F.col("area_id")
    head = F.concat_ws(",", "action_time", "monitor_id", "camera_id", "car")
    speed = F.when(kind == "error", F.lit("n/a")).otherwise(F.col("speed").cast("string"))
    tail = (
        F.when(kind == "click", F.lit(""))
        .when(kind == "signup", F.concat_ws(",", F.lit(""), "road_id", "area_id", F.lit("x")))
        .otherwise(F.concat_ws(",", F.lit(""), "road_id", "area_id"))
    )
    return p.select(F.concat(head, F.lit(","), speed, tail).alias("value"))


def _action_lines(spark: SparkSession, sf: str) -> DataFrame:
    a = testmap.police_actions(spark, sf)
    return a.select(F.concat_ws(",", *a.columns).alias("value"))


def _violation_lines(spark: SparkSession, sf: str) -> DataFrame:
    v = testmap.violations(spark, sf)
    return v.select(F.concat_ws(",", *v.columns).alias("value"))


def _with_monitors(operator, **kw):
    return lambda s, d: operator(testmap.passages(s, d), testmap.monitors(s, d), **kw)


def _on_passages(operator, *args, **kw):
    return lambda s, d: operator(testmap.passages(s, d), *args, **kw)


def _on_police(operator, **kw):
    return lambda s, d: operator(
        testmap.police_actions(s, d), testmap.violations(s, d), **kw
    )


def _watched(spark: SparkSession, sf: str) -> DataFrame:
    return ops.watchlist_passages(
        testmap.passages(spark, sf), testmap.violation_list(spark, sf)
    )


def _tracks(spark: SparkSession, sf: str) -> DataFrame:
    return ops.track_rows(_watched(spark, sf))


def _newest_row(spark: SparkSession, sf: str) -> DataFrame:
    """The row under the first key of a car's trajectory."""
    return ops.lookup_track(_tracks(spark, sf), _newest_key(_tracks(spark, sf)))


def _newest_key(tracks: DataFrame) -> str:
    """A car's first key, or one that no row has if the car has no track."""
    newest = ops.car_track(tracks, CAR).first()
    return newest["row_key"] if newest else f"row_{CAR}_"


def _stored_tracks(spark: SparkSession, sf: str) -> str:
    """The path of the trajectories in a table ordered by key."""
    folder = f"{_own_folder(spark)}/tracks"
    store_tracks(_tracks(spark, sf), folder)
    return folder


def _stored_newest_row(spark: SparkSession, sf: str) -> DataFrame:
    path = _stored_tracks(spark, sf)
    return stored_row(spark, path, _newest_key(stored_track(spark, path, CAR)))


def _united_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Exact counts of sliding days, and whether those of united sketches, which were stored for
    each quarter of a day, lie within five standard errors."""
    passages, quarter = testmap.passages(spark, sf), DAY // 4
    folder = f"{_own_folder(spark)}/sketches"
    ops.area_vehicle_sketches(passages, quarter).write.parquet(folder)
    about = ops.vehicle_count_of_sketches(spark.read.parquet(folder), DAY, quarter)
    starts = F.sequence(*[floor_to(F.col("action_time") - back, quarter) + ahead for back, ahead in ((DAY, quarter), (0, 0))], F.lit(quarter).cast("bigint"))
    windows = passages.withColumn("start_time", F.explode(starts))
    exact = windows.groupBy("area_id", "start_time").agg(F.count_distinct("car").alias("car_count"))
    both = exact.join(about.withColumnRenamed("car_count", "estimate"), ["area_id", "start_time"])
    near = F.abs(F.col("estimate") - F.col("car_count")) <= 5 * SKETCH_RSD * F.col("car_count")
    return both.select("area_id", "start_time", "end_time", "car_count", near.alias("within_bound"))


def _kinds_of_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Good and rejected lines, which one pass of a stream wrote to tables by kind."""
    folder = _own_folder(spark)
    run = {"checkpoint": f"{folder}/checkpoint", "available_now": True}
    _finished(jobs.quality_job(_as_lines(testmap.passages_stream(spark, sf)), f"{folder}/table", **run))
    tables = [
        sinks.read_kind(spark, f"{folder}/table", k).select(F.lit(k).alias("kind"), "value", "action_time", "car", "speed")
        for k in KINDS
    ]
    return reduce(DataFrame.unionByName, tables)


def _from_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Passages from log files that hold their lines."""
    folder = f"{_own_folder(spark)}/logs"
    _lines(spark, sf).write.text(folder)
    return ops.parse_passages(read_log_lines(spark, folder, "*.txt", streaming=False))


def _grow(spark: SparkSession, source: str, logs: str, begin: float, end: float) -> None:
    """Append a share of the bytes of each text file in ``source`` to a log of its name. Tasks
    copy; one that runs again writes the same bytes to the same place."""

    def local(path: str) -> str:
        return unquote(urlparse(path).path) if "://" in path or path.startswith("file:") else path

    def copy(frames):
        for frame in frames:
            for path, size in zip(frame["path"], frame["length"]):
                name = os.path.basename(path).removesuffix(".txt") + ".log"
                os.makedirs(local(logs), exist_ok=True)
                target = os.open(os.path.join(local(logs), name), os.O_CREAT | os.O_WRONLY)
                with open(local(path), "rb") as lines, os.fdopen(target, "wb") as log:
                    at, stop = int(size * begin), int(size * end)
                    lines.seek(at)
                    log.seek(at)
                    log.truncate()
                    while at < stop and (block := lines.read(min(1 << 20, stop - at))):
                        log.write(block)
                        at += len(block)
            yield frame[["length"]]

    files = spark.read.format("binaryFile").load(source).select("path", "length")
    files.mapInPandas(copy, "length long").count()


def _followed_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Passages from logs that grow between two runs of a stream, in the midst of a line."""
    folder = _own_folder(spark)
    _lines(spark, sf).write.text(f"{folder}/lines")
    for begin, end in ((0.0, 0.4), (0.4, 1.0)):
        _grow(spark, f"{folder}/lines", f"{folder}/logs", begin, end)
        passages = ops.parse_passages(follow_log_lines(spark, f"{folder}/logs", "*.log"))
        sink = sinks.append_table(f"{folder}/table")
        _finished(sinks.start(passages, sink, f"{folder}/checkpoint", available_now=True))
    return sinks.read_appended(spark, f"{folder}/table")


def _counts_per_passage(spark: SparkSession, sf: str) -> DataFrame:
    folder = _own_folder(spark)
    run = {"checkpoint": f"{folder}/checkpoint", "available_now": True}
    passages = testmap.passages_stream(spark, sf)
    _finished(jobs.running_count_job(passages, f"{folder}/table", f"{folder}/counts", size_ms=DAY, **run))
    return sinks.read_appended(spark, f"{folder}/table")


def _estimates(spark: SparkSession, sf: str) -> DataFrame:
    """Exact counts, and whether the approximate ones lie within five standard errors."""
    passages, rsd = testmap.passages(spark, sf), 0.02
    keys = ["area_id", "start_time", "end_time"]
    about = ops.area_vehicle_count_bloom(passages, DAY, rsd=rsd)
    both = ops.area_vehicle_count(passages, DAY).join(
        about.withColumnRenamed("car_count", "estimate"), keys
    )
    near = F.abs(F.col("estimate") - F.col("car_count")) <= 5 * rsd * F.col("car_count")
    return both.select(*keys, "car_count", near.alias("within_bound"))


# Streams over the whole events table. Each runs until its input is read, into a table of
# its own in the shared folder.


def _own_folder(spark: SparkSession) -> str:
    return f"{working_folder(spark)}/queries/{uuid.uuid4().hex}"


def _finished(query) -> None:
    query.awaitTermination()


def _stream_into_table(frame: DataFrame) -> DataFrame:
    spark = frame.sparkSession
    folder = _own_folder(spark)
    sink = sinks.append_table(f"{folder}/table")
    _finished(sinks.start(frame, sink, f"{folder}/checkpoint", available_now=True))
    return sinks.read_appended(spark, f"{folder}/table")


def _job_into_table(job, read=sinks.read_appended):
    """``job`` gets (spark, sf, table path, arguments for the run)."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        folder = _own_folder(spark)
        table = f"{folder}/table"
        run_args = {"checkpoint": f"{folder}/checkpoint", "available_now": True}
        _finished(job(spark, sf, table, run_args))
        return read(spark, table)

    return run


def _stream_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "overspeed_stream": _job_into_table(
            lambda s, d, table, run: jobs.overspeed_job(
                testmap.passages_stream(s, d),
                lambda: testmap.monitors(s, d),
                sinks.append_table(table),
                **run,
            )
        ),
        "track_rows_stream": _job_into_table(
            lambda s, d, table, run: jobs.track_job(
                testmap.passages_stream(s, d),
                lambda: testmap.violation_list(s, d),
                sinks.upsert_by_key(table),
                **run,
            ),
            lambda s, table: sinks.read_latest(s, table, "row_key"),
        ),
        "track_rows_merged_stream": _job_into_table(
            lambda s, d, table, run: jobs.track_job(
                testmap.passages_stream(s, d),
                lambda: testmap.violation_list(s, d),
                store.merge_by_key(table, "row_key"),
                **run,
            ),
            store.read_merged,
        ),
        "quality_split_stream": _kinds_of_lines,
        "average_speed_stream": _job_into_table(
            lambda s, d, table, run: jobs.average_speed_job(
                testmap.passages_stream(s, d),
                sinks.append_table(table),
                size_ms=AVG_SIZE,
                slide_ms=AVG_SLIDE,
                **run,
            )
        ),
        "top_congested_stream": _job_into_table(
            lambda s, d, table, run: jobs.congestion_job(
                testmap.passages_stream(s, d),
                sinks.append_table(table),
                size_ms=AVG_SIZE,
                slide_ms=TOP_SLIDE,
                **run,
            )
        ),
        "area_vehicle_count_stream": lambda s, d: _stream_into_table(
            ops.area_vehicle_count(testmap.passages_stream(s, d), DAY)
        ),
        "area_vehicle_count_running_stream": _job_into_table(
            lambda s, d, table, run: jobs.area_count_job(
                testmap.passages_stream(s, d),
                sinks.upsert_by_key(table),
                size_ms=DAY,
                **run,
            ),
            lambda s, table: sinks.read_latest(s, table, "area_id", "start_time"),
        ),
        "police_interval_join_stream": lambda s, d: _stream_into_table(
            ops.police_interval_join(
                testmap.police_actions_stream(s, d),
                testmap.violations_stream(s, d),
                tolerance_ms=TOLERANCE,
            )
        ),
        "police_match_stream": _job_into_table(
            lambda s, d, table, run: jobs.police_job(
                testmap.police_actions_stream(s, d),
                testmap.violations_stream(s, d),
                sinks.append_table(table),
                tolerance_ms=TOLERANCE,
                **run,
            )
        ),
        "dangerous_pairs_stream": lambda s, d: _stream_into_table(
            ops.dangerous_pairs(
                ops.severe_overspeed(
                    testmap.passages_stream(s, d), testmap.monitors(s, d)
                ),
                span_ms=DAY,
            )
        ),
        "dangerous_driving_stream": lambda s, d: _stream_into_table(
            dangerous_driving_stream(
                testmap.passages_stream(s, d), testmap.monitors(s, d), span_ms=DAY
            )
        ),
        "area_vehicle_count_passages_stream": _counts_per_passage,
        "repeat_plate_stream": lambda s, d: _stream_into_table(
            repeat_plate_stream(testmap.passages_stream(s, d), gap_ms=GAP)
        ),
        "repeat_plate_daily_stream": _job_into_table(
            lambda s, d, table, run: jobs.repeat_plate_job(
                testmap.passages_stream(s, d), table, gap_ms=GAP, **run
            )
        ),
    }


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the subpackage ``llm`` and the corpus pipeline, if present."""
    try:
        import corpus_pipeline
        from roadstream.llm import queries as llm
    except ModuleNotFoundError as missing:
        if (missing.name or "") == "corpus_pipeline" or "roadstream.llm" in (missing.name or ""):
            return {}, {}
        raise
    sql = llm.oracle_sql()
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.queries(), "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    repeats = _on_passages(ops.repeat_plate, gap_ms=GAP)
    top = _on_passages(ops.top_congested, 3, AVG_SIZE, TOP_SLIDE)
    return {
        # sources and parsing
        "read_monitors": lambda s, d: tables.monitors_snapshot(testmap.monitors(s, d)),
        "read_violation_list": lambda s, d: tables.violation_list_snapshot(
            testmap.violation_list(s, d)
        ),
        "parse_passages": lambda s, d: ops.parse_passages(_lines(s, d)),
        "read_log_lines": _from_logs,
        "follow_log_lines": _followed_logs,
        "parse_police_actions": lambda s, d: ops.parse_police_actions(
            _action_lines(s, d)
        ),
        "parse_violations": lambda s, d: ops.parse_violations(_violation_lines(s, d)),
        "quality_split": lambda s, d: ops.quality_split(_lines(s, d))[1],
        # passages against dimensions
        "overspeed": _with_monitors(ops.overspeed),
        "with_speed_limits": _with_monitors(ops.with_speed_limits),
        "severe_overspeed": _with_monitors(ops.severe_overspeed),
        "watchlist_passages": _watched,
        "track_rows": _tracks,
        "car_track": lambda s, d: ops.car_track(_tracks(s, d), CAR),
        "lookup_track": _newest_row,
        "stored_car_track": lambda s, d: stored_track(s, _stored_tracks(s, d), CAR),
        "stored_lookup_track": _stored_newest_row,
        # windows
        "average_speed": _on_passages(ops.average_speed, AVG_SIZE, AVG_SLIDE),
        "average_speed_2dp": _on_passages(ops.average_speed_2dp, AVG_SIZE, TOP_SLIDE),
        "top_congested": top,
        "top_congested_report": lambda s, d: ops.top_congested_report(top(s, d)),
        "area_vehicle_count": _on_passages(ops.area_vehicle_count, DAY),
        "area_vehicle_count_running": _on_passages(ops.area_vehicle_count_running, DAY),
        "area_vehicle_count_bloom": _estimates,
        "area_vehicle_count_sketches": _united_sketches,
        # matching, patterns, state
        "police_interval_join": _on_police(
            ops.police_interval_join, tolerance_ms=TOLERANCE
        ),
        "police_match": _on_police(ops.police_match, tolerance_ms=TOLERANCE),
        "dangerous_driving": _with_monitors(ops.dangerous_driving, span_ms=DAY),
        "repeat_plate": repeats,
        "repeat_plate_daily": lambda s, d: ops.repeat_plate_daily(repeats(s, d)),
        **_stream_queries(),
        **_llm()[0],
    }


# The texts of warnings and reports in the SQL below must come out letter by
# letter as the operators write them.

# --- the same in SQL -------------------------------------------------------------------

_VIEWS = """
p as (select epoch_us(ts) // 1000 action_time,
        case event_type when 'signup' then 'u' else '' end
          || json_extract_string(props, '$.k') monitor_id,
        (event_id % 1000)::varchar camera_id, user_id::varchar car, value speed,
        (json_extract_string(props, '$.k')::int % 10)::varchar road_id, event_type area_id
      from events),
m as (select p_partkey::varchar monitor_id, (p_partkey % 10)::varchar road_id,
        greatest(p_size - 5, 0)::int speed_limit, p_brand area_id
      from part),
pa as (select event_id::varchar police_id, user_id::varchar car,
         event_type action_status, epoch_us(ts) // 1000 action_time
       from events where event_type = 'purchase'),
vi as (select user_id::varchar car, event_type msg, epoch_us(ts) // 1000 create_time
       from events where event_type = 'error'),
vl as (select (c_custkey * 3)::varchar car, c_mktsegment || ' ' || (t % 3) violation,
         t create_time
       from (select *, case c_custkey % 5 when 0 then c_custkey + 7 else c_custkey end t
             from customer)),
limited as (select p.car, p.monitor_id, coalesce(m.road_id, p.road_id) road_id,
              p.speed real_speed, coalesce(m.speed_limit, 60)::int limit_speed,
              p.action_time
            from p left join m on p.monitor_id = m.monitor_id),
severe as (select * from limited where limit_speed * 1.2::double < real_speed),
watched as (select p.* from p where car in (select car from vl)),
lines as (select action_time || ',' || monitor_id || ',' || camera_id || ',' || car || ','
            || (case area_id when 'error' then 'n/a' else speed::varchar end)
            || (case area_id when 'click' then ''
                  when 'signup' then ',' || road_id || ',' || area_id || ',x'
                  else ',' || road_id || ',' || area_id end) as value,
            p.* from p)
"""


def _sliding(slide: int) -> str:
    return f"""
w as (select ws start_time, ws + {AVG_SIZE} end_time, monitor_id,
        (sum(speed::decimal(28, 12)) * 1000000)::decimal(38, 6) s, count(*)::bigint n
      from (select p.*, (action_time // {slide} - i) * {slide} ws
            from p, range(0, {-(-AVG_SIZE // slide)}) r(i))
      where ws + {AVG_SIZE} > action_time group by all),
avg2 as (select start_time, end_time, monitor_id,
           floor((2 * s + n * 10000)::double / (2 * n * 10000)::double) / 100.0::double avg_speed,
           n car_count
         from w),
ranked as (select * from (
             select start_time, end_time,
               row_number() over (partition by start_time
                 order by car_count desc, monitor_id)::int as rank,
               monitor_id, car_count, avg_speed
             from avg2) where rank <= 3)
"""


_REPEATS = f"""
o as (select car, action_time, camera_id,
        row_number() over (partition by car order by action_time, camera_id) rn from p),
r as (
  select car, rn, action_time, camera_id, action_time a_t, camera_id a_c, false hit
  from o where rn = 1
  union all
  select o.car, o.rn, o.action_time, o.camera_id,
    case when o.action_time - r.a_t < {GAP} then r.a_t else o.action_time end,
    case when o.action_time - r.a_t < {GAP} then r.a_c else o.camera_id end,
    o.action_time - r.a_t < {GAP}
  from r join o on o.car = r.car and o.rn = r.rn + 1),
repeats as (
  select car,
    case when action_time > a_t then a_c else camera_id end first_camera_id,
    case when action_time > a_t then camera_id else a_c end second_camera_id,
    '存在套牌嫌疑' msg, action_time create_time
  from r where hit)
"""


_SEVERE_IN_ORDER = """q as (select *, row_number() over (partition by car order by action_time,
                 monitor_id, road_id, real_speed, limit_speed) rn from severe)"""

_RUNS = f"""select a.car, '危险驾驶：' || a.car || ' : ' || string_agg(
                  '危险驾驶车辆：OutOfLimitSpeedInfo(' || c.car || ',' || c.monitor_id
                  || ',' || c.road_id || ',' || c.real_speed || ',' || c.limit_speed || ','
                  || c.action_time || ') --', '' order by c.rn) msg,
                  a.action_time create_time, a.real_speed,
                  a.limit_speed::double limit_speed, (b.rn - a.rn + 1)::int n_events,
                  b.action_time last_time
                from q a join q b on a.car = b.car and b.rn > a.rn
                    and b.action_time - a.action_time < {DAY}
                  join q c on c.car = a.car and c.rn between a.rn and b.rn
                group by a.car, a.rn, b.rn, a.action_time, a.real_speed, a.limit_speed, b.action_time"""


def _sql(body: str, *views: str, recursive: bool = False) -> str:
    head = "with recursive " if recursive else "with "
    return head + ",".join((_VIEWS, *views)) + body


def oracle_sql() -> dict[str, str]:
    batch = _batch_sql()
    # A stream gives the windows that its last watermark has closed.
    closed = "end_time <= (select max(epoch_us(ts) // 1000) - 5000 from events)"

    def when_closed(name: str) -> str:
        return f"select * from ({batch[name]}) where {closed}"

    def when_settled(sql: str, time: str) -> str:
        # Rows that are taken in the order of time, once the watermark has passed them.
        return f"select * from ({sql}) where {time} <= (select max(epoch_us(ts) // 1000) - 5000 from events)"

    return {
        **batch,
        "overspeed_stream": batch["overspeed"],
        "track_rows_stream": batch["track_rows"],
        "track_rows_merged_stream": batch["track_rows"],
        "stored_car_track": batch["car_track"],
        "stored_lookup_track": batch["lookup_track"],
        "area_vehicle_count_sketches": _sql(
            f"""select area_id, w start_time, w + {DAY} end_time, count(distinct car)::bigint car_count, true within_bound
                from (select area_id, car, unnest(range(action_time // {DAY // 4} * {DAY // 4} - {3 * (DAY // 4)},
                        action_time // {DAY // 4} * {DAY // 4} + 1, {DAY // 4})) w from p)
                group by all"""
        ),
        "quality_split_stream": _sql(
            """select kind, value, case kind when 'ok' then action_time end action_time, case kind when 'ok' then car end car,
                 case kind when 'ok' then speed end speed
               from (select *, case area_id when 'click' then 'short' when 'error' then 'bad_number' else 'ok' end kind from lines)"""
        ),
        "average_speed_stream": when_closed("average_speed"),
        "top_congested_stream": when_closed("top_congested"),
        "area_vehicle_count_stream": when_closed("area_vehicle_count"),
        # The newest update of every window, open ones included.
        "area_vehicle_count_running_stream": batch["area_vehicle_count"],
        "police_interval_join_stream": batch["police_interval_join"],
        # Left-over rows appear once the watermark of both inputs has passed them.
        "police_match_stream": f"""select * from ({batch["police_match"]})
            where kind = 'matched' or coalesce(action_time, create_time) + {TOLERANCE} < (
              select least(max(epoch_us(ts) // 1000) filter (event_type = 'purchase'),
                max(epoch_us(ts) // 1000) filter (event_type = 'error')) from events)""",
        "dangerous_pairs_stream": _sql(
            f"""select a.car, a.action_time create_time, a.real_speed,
                  a.limit_speed::double limit_speed, b.action_time last_time
                from severe a join severe b on a.car = b.car
                  and (b.action_time, b.monitor_id, b.road_id, b.real_speed,
                       b.limit_speed) > (a.action_time, a.monitor_id, a.road_id,
                       a.real_speed, a.limit_speed)
                  and b.action_time - a.action_time < {DAY}"""
        ),
        "dangerous_driving_stream": _sql(
            f"select * exclude (last_time) from ({_RUNS}) where last_time <= (select max(action_time) - 5000 from severe)",
            _SEVERE_IN_ORDER,
        ),
        "area_vehicle_count_passages_stream": when_settled(batch["area_vehicle_count_running"], "action_time"),
        "repeat_plate_stream": when_settled(batch["repeat_plate"], "create_time"),
        "repeat_plate_daily_stream": when_settled(batch["repeat_plate_daily"], "create_time"),
        **_llm()[1],
    }


def _batch_sql() -> dict[str, str]:
    close = f"abs(pa.action_time - vi.create_time) <= {TOLERANCE}"
    area_window = f"action_time - action_time % {DAY}"
    return {
        "read_monitors": _sql("select * from m"),
        "read_violation_list": _sql("select * from vl"),
        "parse_passages": _sql(
            "select action_time, monitor_id, camera_id, car, speed, road_id, area_id "
            "from p where area_id not in ('click', 'error')"
        ),
        "parse_police_actions": _sql("select * from pa"),
        "parse_violations": _sql("select * from vi"),
        "quality_split": _sql(
            "select value, case area_id when 'click' then 'short' else 'bad_number' end "
            "reason from lines where area_id in ('click', 'error')"
        ),
        "overspeed": _sql(
            "select p.car, p.monitor_id, p.road_id, p.speed real_speed, "
            "m.speed_limit limit_speed, p.action_time "
            "from p join m on p.monitor_id = m.monitor_id "
            "where m.speed_limit > 0 and p.speed > m.speed_limit * 1.1::double"
        ),
        "with_speed_limits": _sql("select * from limited"),
        "severe_overspeed": _sql("select * from severe"),
        "watchlist_passages": _sql("select * from watched"),
        "track_rows": _sql(
            "select 'row_' || car || '_' || (9223372036854775807 - action_time) row_key, "
            "car, action_time, monitor_id, road_id, speed from watched"
        ),
        "follow_log_lines": _sql(
            "select action_time, monitor_id, camera_id, car, speed, road_id, area_id "
            "from p where area_id not in ('click', 'error')"
        ),
        "read_log_lines": _sql(
            "select action_time, monitor_id, camera_id, car, speed, road_id, area_id "
            "from p where area_id not in ('click', 'error')"
        ),
        "car_track": _sql(
            "select 'row_' || car || '_' || (9223372036854775807 - action_time) row_key, "
            f"car, action_time, monitor_id, road_id, speed from watched where car = '{CAR}'"
        ),
        "lookup_track": _sql(
            "select 'row_' || car || '_' || (9223372036854775807 - action_time) row_key, "
            f"car, action_time, monitor_id, road_id, speed from watched where car = '{CAR}' "
            f"and action_time = (select max(action_time) from watched where car = '{CAR}')"
        ),
        "area_vehicle_count_bloom": _sql(
            f"select area_id, {area_window} start_time, {area_window} + {DAY} end_time, "
            "count(distinct car)::bigint car_count, true within_bound from p group by all"
        ),
        "average_speed": _sql(
            "select start_time, end_time, monitor_id, "
            "s::double / (n * 1000000)::double avg_speed, n car_count from w",
            _sliding(AVG_SLIDE),
        ),
        "average_speed_2dp": _sql("select * from avg2", _sliding(TOP_SLIDE)),
        "top_congested": _sql("select * from ranked", _sliding(TOP_SLIDE)),
        "top_congested_report": _sql(
            "select start_time, end_time, '在窗口‘' || start_time || '---' || end_time || "
            "'’时间范围内，整个城市最堵的前3卡口是：' || chr(10) || chr(13) || "
            "string_agg('卡口：' || monitor_id || '，经过的车辆数量：' || car_count || "
            "',平均车速：' || avg_speed || ' ' || chr(10) || chr(13), '' order by rank) "
            "report from ranked group by start_time, end_time",
            _sliding(TOP_SLIDE),
        ),
        "area_vehicle_count": _sql(
            f"select area_id, {area_window} start_time, {area_window} + {DAY} end_time, "
            "count(distinct car)::bigint car_count from p group by all"
        ),
        "area_vehicle_count_running": _sql(
            f"""select area_id, w start_time, w + {DAY} end_time, action_time, car,
                  camera_id, sum(first) over (partition by area_id, w
                    order by action_time, car, camera_id
                    rows unbounded preceding)::bigint car_count
                from (select p.*, {area_window} w, case when row_number() over (
                        partition by area_id, {area_window}, car
                        order by action_time, camera_id) = 1 then 1 else 0 end first
                      from p)"""
        ),
        "police_interval_join": _sql(
            "select pa.car, police_id, action_status, action_time, msg, create_time "
            f"from pa join vi on pa.car = vi.car and {close}"
        ),
        "police_match": _sql(
            "select case when vi.car is null then 'action_only' when pa.car is null "
            "then 'violation_only' else 'matched' end kind, "
            "coalesce(pa.car, vi.car) car, police_id, action_status, action_time, msg, "
            f"create_time from pa full join vi on pa.car = vi.car and {close}"
        ),
        "dangerous_driving": _sql(f"select * exclude (last_time) from ({_RUNS})", _SEVERE_IN_ORDER),
        "repeat_plate": _sql("select * from repeats", _REPEATS, recursive=True),
        "repeat_plate_daily": _sql(
            """select car, day, first_camera_id, second_camera_id, msg, create_time
               from (select *, row_number() over (partition by car, day order by
                       create_time, first_camera_id, second_camera_id) k
                     from (select *, date '1970-01-01'
                             + (create_time // 86400000)::int as day from repeats))
               where k = 1""",
            _REPEATS,
            recursive=True,
        ),
    }
