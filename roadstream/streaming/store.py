"""A table that keeps one row a key, merged batch by batch.

Keys are dealt into buckets. A batch adds a run, sorted by key, to each bucket it touches;
runs of a bucket are merged once there are many, the small ones first, so that a row is
rewritten a few times while the table grows tenfold and readers open few runs. A manifest a
batch names the runs that count. It is put in place last: a batch that fails or is replayed
leaves the manifest before it as it was, and runs that no manifest names are removed.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.plans import files
from roadstream.streaming.sinks import Sink

BUCKETS, RUNS = 16, 4
#: Manifests that are kept, so that a reader may finish with the one it began with.
_KEPT = 2
_SEQ, _BUCKET = "_seq", "_bucket"


def _manifest(spark: SparkSession, path: str, before: int | None = None) -> dict | None:
    """The newest manifest, or the newest of a batch ``before`` the given one."""
    versions = [int(n.split(".")[0]) for n in files.names(spark, f"{path}/manifests") if n.endswith(".json")]
    versions = [v for v in versions if before is None or v < before]
    return json.loads(files.read_text(spark, f"{path}/manifests/{max(versions)}.json")) if versions else None


def _paths(path: str, runs: list[str], bucket: str) -> list[str]:
    return [f"{path}/runs/run={r}/{_BUCKET}={bucket}" for r in runs]


def _read(spark: SparkSession, path: str, manifest: dict, chosen: list[str]) -> DataFrame:
    schema = spark.createDataFrame([], manifest["schema"]).schema
    reader = spark.read.schema(schema).option("basePath", f"{path}/runs")
    return reader.parquet(*chosen).select(schema.names) if chosen else spark.createDataFrame([], schema)


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the latest batch for every key; of one batch the largest."""
    rest = [c for c in rows.columns if c not in (*keys, _SEQ, _BUCKET)]
    best = rows.groupBy(_BUCKET, *keys).agg(F.max(F.struct(_SEQ, *rest)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in (*rest, _SEQ)], _BUCKET)


def _bucket(keys: list[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write_run(rows: DataFrame, keys: list[str], folder: str) -> None:
    """One file a bucket, sorted by key, so that its pages can be skipped by their bounds."""
    (
        rows.repartition(_BUCKET)
        .sortWithinPartitions(_BUCKET, *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(_BUCKET)
        .parquet(folder)
    )


def to_merge(sizes: list[int], runs: int) -> int:
    """How many of a bucket's newest runs to merge: none up to ``runs``; beyond, as many, and
    older ones while the merged run would be half as large as the next."""
    if len(sizes) <= runs:
        return 0
    count = runs
    while count < len(sizes) and 2 * sum(sizes[-count:]) >= sizes[-count - 1]:
        count += 1
    return count


def merge_by_key(
    path: str, *keys: str, buckets: int = BUCKETS, runs: int = RUNS, keep: Column | None = None
) -> Sink:
    """Store rows of which a later batch replaces those with the same key.

    Rows for which ``keep`` is not true may go when runs are merged. Only buckets that a batch touches are written or merged. ``buckets`` belongs to the table;
    take so many that a bucket is some hundred megabytes. Null keys are keys."""
    by = list(keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = _manifest(spark, path, batch_id) or {"buckets": {}, "count": buckets}
        if old["count"] != buckets:
            raise ValueError(f"{path} has {old['count']} buckets")
        rows = batch.withColumn(_SEQ, F.lit(batch_id).cast("bigint")).withColumn(_BUCKET, _bucket([F.col(k) for k in by], buckets))
        fresh = _newest(rows, by)
        run = str(batch_id)
        _write_run(fresh, by, f"{path}/runs/run={run}")
        live = {b: list(r) for b, r in old["buckets"].items()}
        for name in files.names(spark, f"{path}/runs/run={run}"):
            if name.startswith(f"{_BUCKET}="):
                bucket = name.removeprefix(f"{_BUCKET}=")
                size = files.size(spark, f"{path}/runs/run={run}/{name}")
                live.setdefault(bucket, []).append([run, size])
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema if f.name != _BUCKET)
        manifest = {"count": buckets, "keys": by, "schema": f"{schema}, {_BUCKET} int", "buckets": live}
        _merge(spark, path, manifest, f"{batch_id}m", runs, keep)
        files.write_text(spark, f"{path}/manifests/{batch_id}.json", json.dumps(manifest))
        _clean(spark, path, batch_id)

    return write


def _merge(
    spark: SparkSession, path: str, manifest: dict, run: str, runs: int, keep: Column | None
) -> None:
    """Merge the newest runs of buckets that have many, in one job; older runs stay."""
    chosen = {b: n for b, r in manifest["buckets"].items() if (n := to_merge([s for _, s in r], runs))}
    if not chosen:
        return
    parts = [p for b, n in chosen.items() for p in _paths(path, [r for r, _ in manifest["buckets"][b][-n:]], b)]
    merged = _newest(_read(spark, path, manifest, parts), manifest["keys"])
    merged = merged if keep is None else merged.where(keep)
    _write_run(merged, manifest["keys"], f"{path}/runs/run={run}")
    for bucket, n in chosen.items():
        size = files.size(spark, f"{path}/runs/run={run}/{_BUCKET}={bucket}")
        # Without a row left there is no file.
        manifest["buckets"][bucket][-n:] = [[run, size]] if size else []


def _clean(spark: SparkSession, path: str, newest: int) -> None:
    """Remove old manifests, and the runs of buckets that those left do not name."""
    versions = sorted(int(n.split(".")[0]) for n in files.names(spark, f"{path}/manifests") if n.endswith(".json"))
    kept = [v for v in versions if v <= newest][-_KEPT:]
    for version in versions:
        if version < kept[0]:
            files.remove(spark, f"{path}/manifests/{version}.json")
    named = [json.loads(files.read_text(spark, f"{path}/manifests/{v}.json"))["buckets"] for v in versions if v >= kept[0]]
    used = {(r, b) for buckets in named for b, runs in buckets.items() for r, _ in runs}
    for folder in files.names(spark, f"{path}/runs"):
        run = folder.removeprefix("run=")
        buckets = [n.removeprefix(f"{_BUCKET}=") for n in files.names(spark, f"{path}/runs/{folder}") if n.startswith(_BUCKET)]
        gone = [b for b in buckets if (run, b) not in used]
        for bucket in gone if len(gone) < len(buckets) else []:
            files.remove(spark, f"{path}/runs/{folder}/{_BUCKET}={bucket}")
        if len(gone) == len(buckets):
            files.remove(spark, f"{path}/runs/{folder}")


def read_merged(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    """The newest row of every key, also as it was after one of the last two batches. Buckets
    with a single run are read as they are."""
    manifest = _manifest(spark, path, None if batch_id is None else batch_id + 1)
    if manifest is None:
        raise ValueError(f"{path}: no batch has been stored")
    single, several = [], []
    for bucket, runs in manifest["buckets"].items():
        (single if len(runs) == 1 else several).extend(_paths(path, [r for r, _ in runs], bucket))
    merged = _newest(_read(spark, path, manifest, several), manifest["keys"])
    rows = merged.unionByName(_read(spark, path, manifest, single)) if single else merged
    return rows.drop(_SEQ, _BUCKET)


def read_key(spark: SparkSession, path: str, *values) -> DataFrame:
    """The row of one key: the runs of its bucket alone are opened, the key reaches their scan."""
    manifest = _manifest(spark, path)
    if manifest is None:
        raise ValueError(f"{path}: no batch has been stored")
    keys = manifest["keys"]
    types = {f.name: f.dataType for f in spark.createDataFrame([], manifest["schema"]).schema}
    given = [F.lit(v).cast(types[k]) for k, v in zip(keys, values, strict=True)]
    bucket = str(spark.range(1).select(_bucket(given, manifest["count"]).alias("b")).first()["b"])
    runs = [r for r, _ in manifest["buckets"].get(bucket, [])]
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(v) for k, v in zip(keys, given, strict=True)])
    return _newest(_read(spark, path, manifest, _paths(path, runs, bucket)).where(same), keys).drop(_SEQ, _BUCKET)
