"""Online store: keyed snapshots of the latest values.

A view's snapshot (one row per entity) is split into buckets by a hash of its
keys.  ``{root}/{view}/data/<writer's folder>/_bucket=<n>`` holds one bucket, and
the view's manifest names the live folder of each.  An upsert rewrites only the
buckets that its rows touch and publishes them with the writer's mark in one
exclusive step; a writer that was overtaken merges again into what the other one
wrote.  So concurrent writers lose nothing, a replayed batch changes nothing,
and readers see whole versions.  Upserts merge the newest event time per key: a
late, older row never overwrites a newer one.  The newest ``KEEP`` versions stay
for readers that began earlier.  Files are listed through the Hadoop FileSystem
API, so any cluster filesystem works.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetcast.operators.latest import materialize, merge_newest
from fleetcast.sources.manifest import Manifest, ManifestLog

KEEP = 3
BUCKETS = 16   # of a new view; choose them so that a bucket is a few hundred MB


def _folder(root: str, view: str) -> str:
    return f"{root.rstrip('/')}/{view}"


def _bucket(keys, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def committed_versions(spark: SparkSession, root: str, view: str) -> list[int]:
    return ManifestLog(spark, _folder(root, view)).versions()


def _read(spark: SparkSession, folder: str, head: Manifest, parts=None) -> DataFrame:
    schema = T.StructType.fromJson(head.info["schema"])
    paths = [f"{folder}/{p}" for b, p in sorted(head.live.items()) if parts is None or b in parts]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_online(spark: SparkSession, root: str, view: str, version: int | None = None,
                keys: DataFrame | None = None) -> DataFrame | None:
    """Latest committed snapshot of a view (or a given version); None if there is none.

    With ``keys`` (rows of the view's key columns) only the buckets of these
    keys are read: other entities may come along, none of these is missing.
    """
    log = ManifestLog(spark, _folder(root, view))
    head = log.latest() if version is None else log.read(version)
    if not head.version:
        return None
    parts = None
    if keys is not None:
        rows = keys.select(_bucket(head.info["keys"], head.info["buckets"]).alias("b")).distinct().collect()
        parts = {str(r["b"]) for r in rows}   # at most one a bucket
    return _read(spark, log.table, head, parts)


def _write_buckets(rows: DataFrame, log: ManifestLog) -> dict[str, str]:
    """Rows with their ``_bucket`` to a new folder, one task a bucket; bucket -> its folder there."""
    to = f"data/{uuid.uuid4().hex[:16]}"
    rows.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{log.table}/{to}")
    names = [st.getPath().getName() for st in log.fs.listStatus(log.path(f"{log.table}/{to}"))]
    return {n.partition("=")[2]: f"{to}/{n}" for n in names if n.startswith("_bucket=")}


def write_online(snapshot: DataFrame, root: str, view: str, keys=("driver_id",), buckets: int = BUCKETS) -> int:
    """Replace the whole snapshot, as the next version; returns the version number."""
    log = ManifestLog(snapshot.sparkSession, _folder(root, view))
    live = _write_buckets(snapshot.withColumn("_bucket", _bucket(keys, buckets)), log)
    info = {"keys": list(keys), "buckets": buckets, "schema": snapshot.schema.jsonValue()}
    return log.commit(lambda head: Manifest(0, live, head.marks, info)).version


def last_commit(spark: SparkSession, folder: str, writer: str) -> int:
    """The last batch that ``writer`` published to the table in ``folder`` (-1: none)."""
    return ManifestLog(spark, folder).latest().marks.get(writer, -1)


def upsert_online(new_latest: DataFrame, root: str, view: str, keys, commit: tuple[str, int] | None = None,
                  keep: int = KEEP, buckets: int = BUCKETS) -> int:
    """Merge newest-wins into the buckets that the rows touch, and commit the next version.

    ``commit``: (writer, batch) of a stream, by which a replayed batch is known
    and skipped.  When another writer commits first, the buckets that it changed
    are merged again.  Versions older than the newest ``keep`` are deleted.
    """
    spark = new_latest.sparkSession
    log = ManifestLog(spark, _folder(root, view))
    keys, merged_with, written, schema = list(keys), {}, {}, new_latest.schema
    first = log.latest()
    count = first.info.get("buckets", buckets)
    if commit and first.marks.get(commit[0], -1) >= commit[1]:
        return first.version
    placed = new_latest.withColumn("_bucket", _bucket(keys, count)).persist()
    try:
        def change(head: Manifest) -> Manifest | None:
            nonlocal schema
            if commit and head.marks.get(commit[0], -1) >= commit[1]:
                return None
            if head.info and head.info["buckets"] != count:
                raise ValueError(f"{log.table}: the number of buckets was changed while rows were merged")
            if not head.info:
                written.update(_write_buckets(placed, log))
                merged_with.update(dict.fromkeys(written))
            else:
                touched = list(written) or [str(r[0]) for r in placed.select("_bucket").distinct().collect()]
                stale = [b for b in touched if b not in written or head.live.get(b) != merged_with[b]]
                part = placed.where(F.col("_bucket").isin([int(b) for b in stale])).drop("_bucket")
                part = merge_newest(_read(spark, log.table, head, set(stale)), part, keys)
                schema = part.schema
                if stale:
                    written.update(_write_buckets(part.withColumn("_bucket", _bucket(keys, count)), log))
                    merged_with.update({b: head.live.get(b) for b in stale})
            marks = {**head.marks, **({commit[0]: commit[1]} if commit else {})}
            info = {"keys": keys, "buckets": count, "schema": schema.jsonValue()}
            return Manifest(0, {**head.live, **written}, marks, info)

        version = log.commit(change).version
    finally:
        placed.unpersist()
    log.keep_newest(keep)
    return version


# ------------------------------------------------------------------ S11 push

def _files(log: ManifestLog, folder):
    """Data files below a folder, and whether Spark finished writing it."""
    if not log.fs.exists(folder):
        return [], False
    it, out = log.fs.listFiles(folder, True), []
    while it.hasNext():
        at = it.next().getPath()
        if at.getName().startswith("part-"):
            out.append(at)
    return out, log.fs.exists(log.path(f"{folder}/_SUCCESS"))


def _publish_staged(log: ManifestLog, staged) -> None:
    """Move staged files to the table's date folders.  Their names are their own, so a second call goes on."""
    root = staged.toUri().getPath().rstrip("/") + "/"
    for at in _files(log, staged)[0]:
        to = log.path(f"{log.table}/{at.toUri().getPath()[len(root):]}")
        log.fs.mkdirs(to.getParent())
        if not log.fs.rename(at, to):
            raise OSError(f"{at} could not be moved to {to}")


def append_once(rows: DataFrame, path: str, partition_on: str | None = "event_ts",
                commit: tuple[str, int] | None = None) -> None:
    """Append to a table so that every row shows once, wherever a run stops; ``partition_on`` None: without date folders.

    Rows go to a hidden folder named by writer and batch.  A repeated run writes
    it anew if it was not finished; if it was, the run goes on moving its files,
    each by one rename, and then notes the batch.
    """
    from fleetcast.sources.events import write_driver_events

    log = ManifestLog(rows.sparkSession, path)
    if commit and log.latest().marks.get(commit[0], -1) >= commit[1]:
        return
    name = f"{commit[0]}-{commit[1]}" if commit else uuid.uuid4().hex
    staged = log.path(f"{log.table}/_staged/{name}")
    if not _files(log, staged)[1]:
        if partition_on:
            write_driver_events(rows, staged.toString(), partition_on=partition_on, mode="overwrite", table=path)
        else:
            rows.write.mode("overwrite").parquet(staged.toString())
    _publish_staged(log, staged)
    if commit:
        log.commit(lambda head: replace(head, marks={**head.marks, commit[0]: commit[1]}))
        log.keep_newest(KEEP)
    log.fs.delete(staged, True)


def push_features(rows: DataFrame, offline_path: str, online_root: str, views, keys,
                  partition_on: str = "event_ts", commit: tuple[str, int] | None = None) -> None:
    """Append fresh rows offline and upsert their newest values online.

    With ``commit`` (writer, number) a push may be repeated after a failure: each
    side is published once.
    """
    from fleetcast.operators.latest import latest_per_key

    rows = rows.persist()
    try:
        append_once(rows, offline_path, partition_on, commit)
        latest = latest_per_key(rows, keys, "event_ts", ("event_id",) if "event_id" in rows.columns else ())
        for v in views:
            snap = latest.select(*keys, *v.typed_fields(), "event_ts", *[c for c in ("event_id",) if c in rows.columns])
            upsert_online(snap, online_root, v.name, keys, commit)
    finally:
        rows.unpersist()


def materialize_next(events: DataFrame, root: str, view, end, tiebreak=("event_id",)) -> int:
    """A3 from the stored high-water mark: rows after the last run's ``end`` up to this one, merged into the store.

    The mark is published with the rows.  A run up to an earlier time, or the same, changes nothing.
    """
    ts = view.source.timestamp_field
    mark = last_commit(events.sparkSession, _folder(root, view.name), "mark")
    if mark >= 0:
        events = events.where(F.col(ts) > F.timestamp_micros(F.lit(mark)).cast("timestamp_ntz"))
    snap = materialize(events, view, None, end, tiebreak, keep_tiebreak=True)
    upto = (end - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    return upsert_online(snap, root, view.name, list(view.entity_keys), ("mark", upto))


def write_stats(stats: DataFrame, path: str) -> None:
    """Baseline statistics (one row per feature) as JSON; tiny by construction."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    schema = ("feature STRING, count BIGINT, mean DOUBLE, std DOUBLE, p50 DOUBLE, p95 DOUBLE, "
              "min DOUBLE, max DOUBLE")
    return spark.read.schema(schema).json(path)
