"""Structured Streaming jobs.

Every job reads the topic through ``read_events_stream`` (Kafka on a
cluster, a text directory in tests) and reuses the batch operators, so a
stream and a batch run over the same rows give the same result.  Sinks are
exactly-once: either Spark's file sink (its commit log), or ``foreachBatch``
writers that key their output by batch id and skip a batch already committed.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetcast.functions.frames import with_group_index
from fleetcast.operators.latest import latest_per_key
from fleetcast.sources import events as src
from fleetcast.sources import online_store as store
from fleetcast.sources.manifest import ManifestLog


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval or "5 seconds")


def _fs(spark: SparkSession):
    jvm = spark._jvm
    return jvm, spark._jsc.hadoopConfiguration()


def _writer(checkpoint: str) -> str:
    """Name of a stream in commit notes: a new checkpoint folder is a new stream."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _marker_exists(spark: SparkSession, path: str) -> bool:
    jvm, conf = _fs(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def _touch(spark: SparkSession, path: str) -> None:
    jvm, conf = _fs(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).create(p, True).close()


# ---------------------------------------------------------------- T1 ingest

def stream_ingest(spark: SparkSession, lines: DataFrame, offline_path: str, riders_path: str,
                  rejects_path: str, checkpoint: str, available_now: bool = True,
                  interval: str | None = None, audit_path: str | None = None) -> list[StreamingQuery]:
    """T1 (+ S12): topic → decode → route → date-partitioned Parquet, with one audit row per micro-batch.

    One query: a micro-batch is read and decoded once, kept while it is written
    to its tables, and every table notes the batch, so a replay adds nothing.
    """
    writer = _writer(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = src.decode_events(batch).persist()
        note = (writer, batch_id)
        try:
            store.append_once(src.route_driver_events(decoded), offline_path, commit=note)
            store.append_once(src.route_rider_requests(decoded), riders_path, commit=note)
            store.append_once(src.rejects(decoded), rejects_path, None, note)
            if audit_path:
                row = src.ingest_audit(decoded).withColumn("batch_id", F.lit(batch_id))
                store.append_once(row, audit_path, None, note)
        finally:
            decoded.unpersist()
    w = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return [_trigger(w, available_now, interval).start()]


def stream_audit(lines: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 interval: str | None = None) -> StreamingQuery:
    """S12 over a stream: one audit row per micro-batch, appended by batch id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marker = f"{path}/_committed/{batch_id}"
        if _marker_exists(spark, marker):
            return
        src.ingest_audit(src.decode_events(batch)).withColumn("batch_id", F.lit(batch_id)) \
            .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        _touch(spark, marker)
    w = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


# ---------------------------------------------------------------- T2/T3/T7 online

def stream_online(lines: DataFrame, online_root: str, views, checkpoint: str, keys=("driver_id",),
                  available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """Keep each view's snapshot fresh; newest event time wins, late rows never regress.

    A replayed batch finds the note of this stream and does nothing, whoever
    else writes to the store meanwhile.
    """
    drivers = src.route_driver_events(src.decode_events(lines))

    def write(batch: DataFrame, batch_id: int) -> None:
        latest = latest_per_key(batch, list(keys), "event_ts", ("event_id",)).persist()
        try:
            for v in views:
                snap = latest.select(*keys, *v.typed_fields(), "event_ts", "event_id")
                store.upsert_online(snap, online_root, v.name, list(keys), (_writer(checkpoint), batch_id))
        finally:
            latest.unpersist()
    w = drivers.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def stream_push(lines: DataFrame, offline_path: str, online_root: str, views, checkpoint: str,
                keys=("driver_id",), available_now: bool = True,
                interval: str | None = None) -> list[StreamingQuery]:
    """Fresh rows go offline (append) and online (upsert), each exactly once.

    One query, so a micro-batch is decoded once; either side notes the batch, and
    a replay after a failure between the two goes on where it stopped.
    """
    drivers = src.route_driver_events(src.decode_events(lines))

    def write(batch: DataFrame, batch_id: int) -> None:
        store.push_features(batch, offline_path, online_root, views, list(keys), commit=(_writer(checkpoint), batch_id))
    w = drivers.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return [_trigger(w, available_now, interval).start()]


# ---------------------------------------------------------------- T4 match

def stream_match(requests: DataFrame, online_root: str, ranker, out_path: str, checkpoint: str,
                 available_now: bool = True, interval: str | None = None, as_of=None,
                 ttls: dict | None = None) -> StreamingQuery:
    """T4: score requests as they arrive against the newest committed snapshots.

    ``requests``: a stream of decoded rider requests (request_id, rider_id,
    rider_lat, rider_lon, top_k).  Each micro-batch looks for newer snapshots, so
    it always sees the latest features (stream-static join, J8); their search
    index is built once per version and read by all batches until the next.  Every
    request is answered: ``matches`` is an ordered list, empty without candidates
    (also before the first snapshot), and ``error_type`` tells why one was
    rejected.  ``as_of`` (a function of the batch, or None) with ``ttls`` per view
    expires old features as the lookup does, without a new index.
    """
    from fleetcast.operators.match import match_responses
    from fleetcast.operators.spatial import Expiry

    def write(batch: DataFrame, batch_id: int) -> None:
        now = as_of(batch) if as_of else None

        def oldest(view: str):
            ttl = (ttls or {}).get(view)
            return None if now is None or ttl is None else now - ttl
        index = stored_index(batch.sparkSession, online_root, ranker)
        expiry = Expiry(oldest("driver_status"), oldest("driver_agg"))
        match_responses(batch, None, ranker, index=index, expiry=expiry).withColumn("batch_id", F.lit(batch_id)) \
            .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
    w = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def stored_index(spark: SparkSession, online_root: str, ranker, keep: int = 2):
    """The search index of the newest snapshots, from the store; built there by the first that needs it.

    Both views' rows keep their times, so the index serves whatever expiry is
    asked for.  The newest ``keep`` indexes stay.
    """
    from fleetcast.operators.match import drop_unlocated
    from fleetcast.operators.spatial import LAYOUT, DriverIndex, build_index

    views = (("driver_status", ["lat", "lon"], "position_ts"),
             ("driver_agg", ["accept_rate_7d", "avg_response_ms"], "features_ts"))
    versions = [max(store.committed_versions(spark, online_root, v), default=0) for v, _, _ in views]
    made_for = json.dumps([LAYOUT, versions, ranker.to_row()], sort_keys=True)
    log = ManifestLog(spark, f"{online_root.rstrip('/')}/_index")

    def found(head) -> str | None:
        return head.info.get("made", {}).get(made_for)

    def build(head):
        if found(head):
            return None
        snap = None
        for (view, fields, ts), version in zip(views, versions):
            got = store.read_online(spark, online_root, view, version) if version else spark.createDataFrame(
                [], "driver_id string, event_ts timestamp_ntz, " + ", ".join(f"{f} double" for f in fields))
            got = got.select("driver_id", *fields, F.col("event_ts").alias(ts))
            snap = got if snap is None else snap.join(got, "driver_id", "left")
        name = f"index={uuid.uuid4().hex[:12]}"
        build_index(drop_unlocated(snap), ranker).save(f"{log.table}/{name}")
        made = dict(list(head.info.get("made", {}).items())[-(keep - 1):] if keep > 1 else [], **{made_for: name})
        return replace(head, live={n: n for n in made.values()}, info={"made": made})

    head = log.latest()
    if not found(head):
        head = log.commit(build)
        log.keep_newest(keep)
    return DriverIndex.load(spark, f"{log.table}/{found(head)}")


# ---------------------------------------------------------------- T5 drift

def stream_drift(observations: DataFrame, baseline: DataFrame, state_root: str, out_path: str,
                 checkpoint: str, order_cols, window: int = 1000, step: int = 100,
                 available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """T5: A14 over a stream, state kept as a versioned table (no Python state).

    State per feature: total observations so far and the last ``window - 1``
    values.  Each batch numbers its rows after the stored total, computes the
    checkpoints it completes from (tail ∪ batch), and commits the new state
    with its number.  One state is live and the one before it is kept for a
    replay, however many batches there were.  The rows of a feature are never
    one task's: there may be few features and a large batch.  The state is this
    stream's own: a new checkpoint folder starts from nothing.
    """
    from fleetcast.operators.drift import drift_checkpoints

    order_cols = list(order_cols)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = ManifestLog(spark, f"{state_root.rstrip('/')}/drift-{_writer(checkpoint)}")
        head = log.latest()
        if head.marks.get("batch", -1) >= batch_id:
            return
        clean = batch.where(F.col("value").isNotNull() & ~F.isnan("value")).join(
            F.broadcast(baseline.select("feature_name")), "feature_name", "left_semi")
        schema = "feature_name string, _n long, value double, total long"
        tail = spark.read.schema(schema).parquet(f"{log.table}/{head.live['tail']}") if head.live \
            else spark.createDataFrame([], schema)
        totals = tail.groupBy("feature_name").agg(F.max("total").alias("_lo"))
        numbered = with_group_index(clean, order_cols, ["feature_name"], "_i") \
            .join(F.broadcast(totals), "feature_name", "left") \
            .select("feature_name", "value", (F.coalesce("_lo", F.lit(0)) + F.col("_i") + 1).alias("_n"))
        both = tail.select("feature_name", "_n", "value").unionByName(numbered).persist()
        try:
            bounds = both.groupBy("feature_name").agg(F.max("_n").alias("_hi")) \
                .join(totals, "feature_name", "left").fillna(0, ["_lo"])
            drift_checkpoints(both, bounds, baseline, window, step).withColumn("batch_id", F.lit(batch_id)) \
                .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
            keep = both.join(F.broadcast(bounds.select("feature_name", F.col("_hi").alias("total"))), "feature_name") \
                .where(F.col("_n") > F.col("total") - F.lit(window - 1))
            to = f"tail={uuid.uuid4().hex[:12]}"
            # One file by a shuffle of the few rows kept; ``coalesce`` would read the whole batch in one task.
            keep.select("feature_name", "_n", "value", "total").repartition(1).write.parquet(f"{log.table}/{to}")
        finally:
            both.unpersist()
        log.commit(lambda h: replace(h, live={"tail": to}, marks={"batch": batch_id}))
        log.keep_newest(2)
    w = observations.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


# ---------------------------------------------------------------- T6 metrics / T8 dedupe

def stream_metrics(calls: DataFrame, bounds, value: str, ts: str, out_path: str, checkpoint: str,
                   width: str = "1 minute", watermark: str = "10 minutes", labels=(),
                   available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """Per event-time window and bucket, observation counts (append once the watermark passes).

    Cumulative ``le`` series and quantiles are computed from these rows in
    batch (A12/A18), since a running sum over buckets is not a streaming
    aggregate.
    """
    from fleetcast.operators.metrics import bucket_le

    # Watermarks need TIMESTAMP; in a UTC session the cast keeps the wall clock.
    obs = calls.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark) \
        .where(F.col(value).isNotNull()) \
        .withColumn("le", bucket_le(F.col(value), bounds))
    agg = obs.groupBy(F.window(ts, width).alias("w"), *labels, "le").agg(
        F.count(F.lit(1)).alias("bucket_count"), F.sum(value).alias("sum"))
    out = agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *labels, "le",
                     "bucket_count", "sum")
    w = out.writeStream.format("parquet").option("path", out_path) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(w, available_now, interval).start()


def stream_rates(observations: DataFrame, bounds, value: str, ts: str, out_path: str, checkpoint: str,
                 width: str = "5 minutes", slide: str = "1 minute", watermark: str = "10 minutes", labels=(),
                 available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """T6 (A12, A16, A17): cumulative ``le`` series and per-second rates over sliding windows.

    A window is written once, when the watermark has passed its end; until then
    late rows count.
    """
    from fleetcast.operators.metrics import bucket_rates

    # Watermarks need TIMESTAMP; in a UTC session the cast keeps the wall clock.
    obs = observations.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    w = bucket_rates(obs, value, bounds, ts, width, slide, labels).writeStream.format("parquet") \
        .option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(w, available_now, interval).start()


def dedupe_events(drivers: DataFrame, watermark: str | None = "1 hour",
                  keys=("driver_id", "event_ts", "event_id")) -> DataFrame:
    """Drop repeated deliveries (same key, event time and event id).

    Streams keep state only within the watermark; batches drop all repeats.
    """
    if drivers.isStreaming and watermark:
        ntz = dict(drivers.dtypes).get("event_ts") == "timestamp_ntz"
        d = drivers.withColumn("event_ts", F.col("event_ts").cast("timestamp")) if ntz else drivers
        d = d.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark(list(keys))
        return d.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz")) if ntz else d
    return drivers.dropDuplicates(list(keys))
