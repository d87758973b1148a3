"""Sinks and streaming jobs: exactly-once replays, stream == batch."""

import datetime as dt
import os

from pyspark.sql import functions as F

from fleetcast.functions.scoring import FIXTURE_RANKER
from fleetcast.operators import latest as lt
from fleetcast.operators.drift import drift_score
from fleetcast.plans import fixtures as fx
from fleetcast.sources import events as src
from fleetcast.sources import online_store as store
from fleetcast.specs import DRIVER_AGG, DRIVER_STATUS
from fleetcast.streaming import jobs

from paths import SF_SMALL


def _write_lines(df, path, parts=3):
    """Split the fixture topic lines into ``parts`` text files (one micro-batch each)."""
    rows = [r["value"] for r in df.collect()]
    os.makedirs(path, exist_ok=True)
    step = -(-len(rows) // parts)
    for i in range(parts):
        with open(os.path.join(path, f"part-{i:03d}.txt"), "w") as fh:
            fh.write("\n".join(rows[i * step:(i + 1) * step]) + "\n")
    return len(rows)


def _events(spark):
    return fx.load_table(spark, SF_SMALL, "events")


def test_offline_write_read_prunes_and_round_trips(spark, tmp_dir):
    ev = _events(spark)
    drivers = src.route_driver_events(src.decode_events(fx.driver_events_json(ev)))
    path = f"{tmp_dir}/offline"
    src.write_driver_events(drivers, path)
    back = src.read_offline_events(spark, path, ["driver_id", "event_ts"],
                                   start=dt.datetime(2024, 1, 3), end=dt.datetime(2024, 1, 5, 23, 59))
    want = drivers.where(F.col("event_ts").between(dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 5, 23, 59)))
    assert back.count() == want.count() > 0
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_ts" in plan
    from fleetcast.specs import SourceSpec
    via_spec = src.feature_source(spark, SourceSpec(path, "event_ts"), ["driver_id", "event_ts"],
                                  start=dt.datetime(2024, 1, 3), end=dt.datetime(2024, 1, 5, 23, 59))
    assert via_spec.count() == back.count()


def test_stream_ingest_is_exactly_once(spark, tmp_dir):
    ev = _events(spark)
    n = _write_lines(fx.topic_lines(ev), f"{tmp_dir}/in", parts=3)
    assert n > 0
    lines = src.read_events_stream(spark, path=f"{tmp_dir}/in", max_per_trigger=1)
    for _ in range(2):   # a rerun with the same checkpoint adds nothing
        for q in jobs.stream_ingest(spark, lines, f"{tmp_dir}/off", f"{tmp_dir}/riders", f"{tmp_dir}/rej",
                                    f"{tmp_dir}/ck"):
            q.awaitTermination()
    batch = src.decode_events(fx.topic_lines(ev))
    assert spark.read.parquet(f"{tmp_dir}/off").count() == src.route_driver_events(batch).count()
    assert spark.read.parquet(f"{tmp_dir}/riders").count() == src.route_rider_requests(batch).count()
    assert spark.read.parquet(f"{tmp_dir}/rej").count() == src.rejects(batch).count()
    # one more file arrives -> only its rows are appended
    extra = fx.driver_events_json(ev).limit(50)
    _write_lines(extra, f"{tmp_dir}/in2", parts=1)
    os.rename(f"{tmp_dir}/in2/part-000.txt", f"{tmp_dir}/in/part-new.txt")
    before = spark.read.parquet(f"{tmp_dir}/off").count()
    for q in jobs.stream_ingest(spark, lines, f"{tmp_dir}/off", f"{tmp_dir}/riders", f"{tmp_dir}/rej",
                                f"{tmp_dir}/ck"):
        q.awaitTermination()
    added = src.route_driver_events(src.decode_events(extra)).count()
    assert spark.read.parquet(f"{tmp_dir}/off").count() == before + added


def test_stream_online_equals_batch_snapshot(spark, tmp_dir):
    ev = _events(spark)
    _write_lines(fx.driver_events_json(ev), f"{tmp_dir}/in", parts=4)
    lines = src.read_events_stream(spark, path=f"{tmp_dir}/in", max_per_trigger=1)
    for _ in range(2):
        jobs.stream_online(lines, f"{tmp_dir}/online", [DRIVER_STATUS, DRIVER_AGG], f"{tmp_dir}/ck") \
            .awaitTermination()
    got = store.read_online(spark, f"{tmp_dir}/online", "driver_status")
    drivers = src.route_driver_events(src.decode_events(fx.driver_events_json(ev)))
    want = lt.materialize(drivers, DRIVER_STATUS, keep_tiebreak=True)
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
    # four batches, four versions; the replay added none, and only the newest stay
    assert store.committed_versions(spark, f"{tmp_dir}/online", "driver_status") == [2, 3, 4]


def test_stream_push_and_match(spark, tmp_dir):
    ev = _events(spark)
    _write_lines(fx.driver_events_json(ev), f"{tmp_dir}/in", parts=2)
    lines = src.read_events_stream(spark, path=f"{tmp_dir}/in", max_per_trigger=1)
    for _ in range(2):   # a rerun with the same checkpoint pushes nothing twice
        for q in jobs.stream_push(lines, f"{tmp_dir}/off", f"{tmp_dir}/online", [DRIVER_STATUS, DRIVER_AGG],
                                  f"{tmp_dir}/ck"):
            q.awaitTermination()
    drivers = src.route_driver_events(src.decode_events(fx.driver_events_json(ev)))
    assert spark.read.parquet(f"{tmp_dir}/off").count() == drivers.count()
    # requests stream scored against the pushed snapshot
    _write_lines(fx.rider_requests_json(ev), f"{tmp_dir}/req", parts=2)
    reqs = src.route_rider_requests(src.decode_events(
        src.read_events_stream(spark, path=f"{tmp_dir}/req", max_per_trigger=1))) \
        .withColumn("top_k", F.lit(3))
    jobs.stream_match(reqs, f"{tmp_dir}/online", FIXTURE_RANKER, f"{tmp_dir}/matches", f"{tmp_dir}/ck2") \
        .awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/matches")
    n_req = fx.rider_requests(ev).count()
    assert out.count() == n_req == out.where("error_type is null and size(matches) = 3").count()


def test_stream_match_answers_every_request(spark, tmp_dir):
    """Before the first snapshot the list is empty; rejected requests get a reason; old positions expire."""
    rows = [("r1", "u", 40.7, -74.0, 2), ("r2", "u", 40.7, -74.0, 0), ("r3", "u", float("nan"), -74.0, 1), (None, "u", 1.0, 1.0, 1)]
    schema = "request_id string, rider_id string, rider_lat double, rider_lon double, top_k int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/req")
    reqs = spark.readStream.schema(schema).parquet(f"{tmp_dir}/req")
    jobs.stream_match(reqs, f"{tmp_dir}/online", FIXTURE_RANKER, f"{tmp_dir}/m1", f"{tmp_dir}/ck1").awaitTermination()
    got = {r["request_id"]: (r["error_type"], len(r["matches"])) for r in spark.read.parquet(f"{tmp_dir}/m1").collect()}
    assert got == {"r1": (None, 0), "r2": ("invalid_top_k", 0), "r3": ("missing_location", 0),
                   None: ("missing_request_id", 0)}
    now = dt.datetime(2024, 1, 1, 12)
    snap = spark.createDataFrame([("d1", 40.7, -74.0, "idle", now), ("d2", 40.7, -74.0, "idle", now - dt.timedelta(hours=2))],
                                 "driver_id string, lat double, lon double, status string, event_ts timestamp_ntz")
    store.write_online(snap, f"{tmp_dir}/online", "driver_status")
    jobs.stream_match(reqs, f"{tmp_dir}/online", FIXTURE_RANKER, f"{tmp_dir}/m2", f"{tmp_dir}/ck2", as_of=lambda b: now,
                      ttls={"driver_status": dt.timedelta(hours=1)}).awaitTermination()
    got = {r["request_id"]: [m["driver_id"] for m in r["matches"]] for r in spark.read.parquet(f"{tmp_dir}/m2").collect()}
    assert got["r1"] == ["d1"] and got["r2"] == []


def test_range_over_folders_by_ingest_date(spark, tmp_dir):
    schema = "driver_id string, event_ts timestamp_ntz, lat double"
    rows = spark.createDataFrame([(f"d{i}", dt.datetime(2024, 1, 1 + i), 1.0) for i in range(5)], schema)
    for clock in ("ingest_ts", "event_ts"):
        src.write_driver_events(rows, f"{tmp_dir}/{clock}", partition_on=clock)
        got = src.read_offline_events(spark, f"{tmp_dir}/{clock}", ["driver_id"], dt.datetime(2024, 1, 2),
                                      dt.datetime(2024, 1, 4))
        assert sorted(r[0] for r in got.collect()) == ["d1", "d2", "d3"]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("make_date" in plan) == (clock == "event_ts")
    src.write_driver_events(rows, f"{tmp_dir}/event_ts", partition_on="ingest_ts")  # a mixed table is not pruned
    assert src.read_offline_events(spark, f"{tmp_dir}/event_ts", ["driver_id"], dt.datetime(2024, 1, 2),
                                   dt.datetime(2024, 1, 4)).count() == 6


def test_stream_drift_equals_batch(spark, tmp_dir):
    import random
    rnd = random.Random(4)
    rows = [("f", i, rnd.uniform(0, 10)) for i in range(2600)]
    base = spark.createDataFrame([("f", 9.0)], "feature_name string, p95 double")
    os.makedirs(f"{tmp_dir}/obs", exist_ok=True)
    for part in range(3):
        chunk = rows[part * 900:(part + 1) * 900]
        spark.createDataFrame(chunk, "feature_name string, seq long, value double").coalesce(1) \
            .write.mode("overwrite").parquet(f"{tmp_dir}/obs/p{part}")
        os.system(f"mv {tmp_dir}/obs/p{part}/*.parquet {tmp_dir}/obs/part{part}.parquet")
    stream = spark.readStream.schema("feature_name string, seq long, value double") \
        .option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/obs")
    jobs.stream_drift(stream, base, f"{tmp_dir}/state", f"{tmp_dir}/drift", f"{tmp_dir}/ck", ["seq"]) \
        .awaitTermination()
    got = {(r["observations"], round(r["drift"], 12)) for r in spark.read.parquet(f"{tmp_dir}/drift").collect()}
    batch = spark.createDataFrame(rows, "feature_name string, seq long, value double")
    want = {(r["observations"], round(r["drift"], 12)) for r in drift_score(batch, base, ["seq"]).collect()}
    assert got == want and len(want) == 26


def test_stream_metrics_windows(spark, tmp_dir):
    calls = fx.calls(_events(spark)).select("ts", "latency_s", "error_type")
    calls.write.parquet(f"{tmp_dir}/calls")
    stream = spark.readStream.schema(calls.schema).parquet(f"{tmp_dir}/calls")
    from fleetcast.operators.metrics import LATENCY_BOUNDS
    jobs.stream_metrics(stream, LATENCY_BOUNDS, "latency_s", "ts", f"{tmp_dir}/m", f"{tmp_dir}/ck",
                        watermark="0 seconds").awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/m")
    # Every closed window equals the batch aggregation; only the last window
    # (it holds the newest event, so the watermark has not passed it) may be missing.
    from fleetcast.operators.metrics import bucket_le
    batch = (calls.where(F.col("latency_s").isNotNull())
             .groupBy(F.window("ts", "1 minute").start.cast("timestamp_ntz").alias("window_start"),
                      bucket_le(F.col("latency_s"), LATENCY_BOUNDS).alias("le"))
             .agg(F.count(F.lit(1)).alias("bucket_count"), F.sum("latency_s").alias("sum")))
    last = batch.agg(F.max("window_start")).first()[0]
    want = {(r[0], r[1]): (r[2], round(r[3], 9)) for r in batch.where(F.col("window_start") < F.lit(last)).collect()}
    got = {(r["window_start"], r["le"]): (r["bucket_count"], round(r["sum"], 9)) for r in out.collect()
           if r["window_start"] < last}
    assert got == want and len(want) > 100


def test_dedupe_and_model_persistence(spark, tmp_dir):
    ev = _events(spark)
    drivers = src.route_driver_events(src.decode_events(fx.driver_events_json(ev)))
    assert jobs.dedupe_events(drivers.unionByName(drivers)).count() == drivers.count()
    from fleetcast.operators import model as md
    md.save_ranker(spark, FIXTURE_RANKER, None, f"{tmp_dir}/model")
    assert md.load_ranker(spark, f"{tmp_dir}/model") == FIXTURE_RANKER
    md.record_run(spark, f"{tmp_dir}/runs", {"a": 1}, {"auc": 0.5})
    md.record_run(spark, f"{tmp_dir}/runs", {"a": 2}, {"auc": 0.6})
    assert spark.read.parquet(f"{tmp_dir}/runs").count() == 2
    stats = spark.createDataFrame([("x", 3, 1.0, 0.5, 1.0, 2.0, 0.0, 2.0)],
                                  "feature string, count bigint, mean double, std double, p50 double, "
                                  "p95 double, min double, max double")
    store.write_stats(stats, f"{tmp_dir}/stats")
    assert store.read_stats(spark, f"{tmp_dir}/stats").first()["p95"] == 2.0


def test_decode_fail_fast_and_permissive(spark):
    import pytest
    good = '{"event_type":"driver_update","driver_id":"d1","lat":1.0,"lon":2.0,"timestamp":"2024-01-01T00:00:00Z"}'
    lines = spark.createDataFrame([(good,), ("not json",), ("",)], "value string")
    with pytest.raises(Exception):
        src.decode_events(lines, on_bad="fail").collect()
    dec = src.decode_events(lines)
    errors = sorted((r["_error"] or "ok") for r in dec.select("_error").collect())
    assert errors == ["empty", "malformed_json", "ok"]
    row = src.route_driver_events(dec).first()
    assert row["event_ts"] == dt.datetime(2024, 1, 1) and row["driver_id"] == "d1"
    bad_ts = spark.createDataFrame([(good.replace("2024-01-01T00:00:00Z", "yesterday"),)], "value string")
    assert src.decode_events(bad_ts).first()["_error"] == "bad_timestamp"


def test_online_upsert_versions_are_idempotent(spark, tmp_dir):
    schema = "driver_id string, lat double, event_ts timestamp_ntz"
    a = spark.createDataFrame([("d1", 1.0, dt.datetime(2024, 1, 1, 10)), ("d2", 2.0, dt.datetime(2024, 1, 1, 10))], schema)
    b = spark.createDataFrame([("d1", 9.0, dt.datetime(2024, 1, 1, 9)), ("d3", 3.0, dt.datetime(2024, 1, 1, 11))], schema)
    root = f"{tmp_dir}/online"
    keys = ["driver_id"]
    assert store.upsert_online(a, root, "v", keys) == 1                       # a batch job takes number 1
    assert store.upsert_online(b, root, "v", keys, ("s", 0)) == 2             # a stream's batch 0 is not lost
    changed = spark.createDataFrame([("d1", 0.0, dt.datetime(2024, 1, 2))], schema)
    assert store.upsert_online(changed, root, "v", keys, ("s", 0)) == 2       # its replay changes nothing
    got = {r["driver_id"]: r["lat"] for r in store.read_online(spark, root, "v").collect()}
    assert got == {"d1": 1.0, "d2": 2.0, "d3": 3.0}   # d1's late, older row did not win
    assert store.committed_versions(spark, root, "v") == [1, 2]
    assert {r["driver_id"] for r in store.read_online(spark, root, "v", version=1).collect()} == {"d1", "d2"}
    assert store.upsert_online(changed, root, "v", keys, ("other", 0)) == 3   # another stream has its own numbers
    assert store.upsert_online(a, root, "v", keys, ("s", 1)) == 4
    assert store.committed_versions(spark, root, "v") == [2, 3, 4]
    assert store.last_commit(spark, f"{root}/v", "s") == 1 and store.last_commit(spark, f"{root}/v", "new") == -1
    push = spark.createDataFrame([("e1", "d1", dt.datetime(2024, 1, 3), 5.0, 1.0, "idle", 0.5, 9.0)],
                                 "event_id string, driver_id string, event_ts timestamp_ntz, lat double, lon double, "
                                 "status string, accept_rate_7d double, avg_response_ms double")
    for _ in range(2):
        store.push_features(push, f"{tmp_dir}/off", root, [DRIVER_STATUS, DRIVER_AGG], keys, commit=("p", 7))
    assert spark.read.parquet(f"{tmp_dir}/off").count() == 1
    assert store.read_online(spark, root, "driver_agg").first()["accept_rate_7d"] == 0.5


def test_events_of_one_instant_merge_as_in_one_batch(spark, tmp_dir):
    """The larger event id wins, whatever its values and whichever run brings it."""
    t = dt.datetime(2024, 1, 1)
    schema = "event_id long, driver_id string, event_ts timestamp_ntz, accept_rate_7d double, avg_response_ms double"
    a = spark.createDataFrame([(2, "d1", t, 0.5, 1.0)], schema)
    b = spark.createDataFrame([(1, "d1", t, 0.9, 9.0)], schema)
    for n, parts in enumerate(((a, b), (b, a), (a.unionByName(b),))):
        for part in parts:
            store.upsert_online(lt.materialize(part, DRIVER_AGG, keep_tiebreak=True), f"{tmp_dir}/o{n}", "driver_agg",
                                ["driver_id"])
        assert store.read_online(spark, f"{tmp_dir}/o{n}", "driver_agg").first()["accept_rate_7d"] == 0.5


def test_incremental_runs_go_on_from_the_stored_mark(spark, tmp_dir):
    t = dt.datetime(2024, 1, 1)
    schema = "event_id long, driver_id string, event_ts timestamp_ntz, accept_rate_7d double, avg_response_ms double"
    rows = [(i, f"d{i % 2}", t + dt.timedelta(hours=i), i / 10, 1.0) for i in range(6)]
    for end, want in ((3, {"d0": 0.2, "d1": 0.3}), (5, {"d0": 0.4, "d1": 0.5}), (5, {"d0": 0.4, "d1": 0.5})):
        store.materialize_next(spark.createDataFrame(rows, schema), f"{tmp_dir}/on", DRIVER_AGG, t + dt.timedelta(hours=end))
        got = {r["driver_id"]: r["accept_rate_7d"] for r in store.read_online(spark, f"{tmp_dir}/on", "driver_agg").collect()}
        assert got == want
