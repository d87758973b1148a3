"""Counter rates with resets, sliding windows, order statistics without a sort, bounded stream state, stored index."""

import datetime as dt
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetcast.functions.scoring import FIXTURE_RANKER
from fleetcast.operators import metrics as mx
from fleetcast.operators import quality as qa
from fleetcast.sources import online_store as store
from fleetcast.sources.manifest import ManifestLog
from fleetcast.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def plain_rates(rows, width, slide):
    out, series = {}, {}
    for s, t, n, v in sorted(r for r in rows if None not in (r[0], r[1], r[3])):
        series.setdefault(s, []).append((t, n, v))
    for s, points in series.items():
        steps = [None] + [b[2] - a[2] if b[2] >= a[2] else b[2] for a, b in zip(points, points[1:])]
        start = points[0][0].replace(second=0, microsecond=0) - width - dt.timedelta(minutes=points[0][0].minute)
        while start <= points[-1][0]:
            inside = [i for i, p in enumerate(points) if start <= p[0] < start + width]
            if inside:
                up = sum(steps[i] for i in inside[1:])
                seconds = (points[inside[-1]][0] - points[inside[0]][0]).total_seconds()
                out[s, start] = (len(inside), round(up, 9), round(up / seconds, 9) if seconds else None)
            start += slide
    return out


def test_counter_rates_with_resets(spark):
    rng = random.Random(2)
    rows, value = [], {"a": 0, "b": 0, "hot": 0}
    for n in range(900):
        s = "hot" if rng.random() < 0.6 else rng.choice("ab")
        value[s] = 0 if rng.random() < 0.03 else value[s] + rng.randrange(5)
        rows.append((s, T0 + dt.timedelta(seconds=rng.randrange(4 * n, 4 * n + 4)), n, float(value[s])))
    rows += [("a", None, 1000, 3.0), ("a", T0, 1001, None), (None, T0, 1002, 1.0)]
    df = spark.createDataFrame(rows, "s string, t timestamp_ntz, n int, v double").repartition(5)
    got = mx.counter_rates(df, "v", "t", "10 minutes", "5 minutes", ["s"], ["n"]).collect()
    assert {(r["s"], r["window_start"]): (r["samples"], round(r["increase"], 9),
                                          None if r["rate"] is None else round(r["rate"], 9)) for r in got} \
        == plain_rates(rows, dt.timedelta(minutes=10), dt.timedelta(minutes=5))


def test_bucket_rates_are_cumulative_in_every_window(spark):
    rows = [(T0 + dt.timedelta(seconds=20 * i), i / 10) for i in range(60)] + [(T0, None)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, v double")
    got = {(r["window_start"], r["le"]): (r["bucket_count"], r["rate"])
           for r in mx.bucket_rates(df, "v", (1.0, 3.0), "t", "10 minutes", "5 minutes").collect()}
    for start in (T0 + dt.timedelta(minutes=5 * k) for k in range(-1, 4)):
        v = [x for t, x in rows if x is not None and start <= t < start + dt.timedelta(minutes=10)]
        for le in (1.0, 3.0, math.inf):
            n = sum(x <= le for x in v)
            assert got[start, le] == (n, n / 600)


@pytest.mark.parametrize("kind", ["even", "heavy", "two", "ends", "near"])
def test_order_statistics_at_any_spread(spark, monkeypatch, kind):
    monkeypatch.setattr(qa, "SELECT_ROWS", 40)
    rng = np.random.default_rng(8)
    v = {"even": rng.uniform(-5, 5, 4000), "heavy": np.exp(rng.normal(0, 60, 4000)) * rng.choice([-1, 1], 4000),
         "two": rng.choice([1.0, 2.0], 400), "ends": np.append(rng.normal(0, 1, 500), [np.inf, -np.inf]),
         "near": 1e15 + rng.integers(0, 900, 3000).astype(float)}[kind]
    df = spark.createDataFrame([("f", float(x)) for x in v] + [("g", 3.0), ("f", None)], "feature string, value double")
    counts = qa.value_counts(df.repartition(4))
    totals = qa._totals(counts, "feature", "value")
    ranks = {0, 1, len(v) // 3, len(v) // 2, len(v) - 2, len(v) - 1}
    got = qa.order_statistics(counts, {"f": ranks, "g": {0}}, totals)
    assert got == {**{("f", r): float(np.sort(v)[r]) for r in ranks}, ("g", 0): 3.0}


def test_feature_baseline_reads_once_and_without_a_sort(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(5, 2, 3000), rng.integers(0, 4, 3000).astype(float)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def count(v):
        seen.add(1)
        return v
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), [None] * 3000)), "x double, y double, z double")
    got = {r["feature"]: r for r in qa.feature_baseline(df.withColumn("x", count("x")), ["x", "y", "z"]).collect()}
    assert seen.value == 3000 and set(got) == {"x", "y"}
    for name, v in (("x", x), ("y", y)):
        want = [len(v), v.mean(), v.std(ddof=1), *np.quantile(v, [0.5, 0.95]), v.min(), v.max()]
        assert np.allclose([got[name][c] for c in ("count", "mean", "std", "p50", "p95", "min", "max")], want, rtol=1e-12)
    assert qa.feature_baseline(df.limit(0), ["x"]).count() == 0


def test_drift_state_stays_small_over_many_batches(spark, tmp_dir):
    base = spark.createDataFrame([("f", 9.0)], "feature_name string, p95 double")
    os.makedirs(f"{tmp_dir}/obs")
    stream = spark.readStream.schema("feature_name string, seq long, value double").option("maxFilesPerTrigger", 1) \
        .parquet(f"{tmp_dir}/obs")
    for n in range(6):
        spark.range(n * 300, (n + 1) * 300).select(F.lit("f").alias("feature_name"), F.col("id").alias("seq"),
                                                   F.col("id").cast("double").alias("value")) \
            .coalesce(1).write.mode("append").parquet(f"{tmp_dir}/obs")
        if n in (3, 5):
            jobs.stream_drift(stream, base, f"{tmp_dir}/state", f"{tmp_dir}/out", f"{tmp_dir}/ck", ["seq"]).awaitTermination()
    log = ManifestLog(spark, f"{tmp_dir}/state/drift-{jobs._writer(f'{tmp_dir}/ck')}")
    head = log.latest()
    assert head.version == 6 and head.marks == {"batch": 5} and len(log.versions()) == 2
    assert len([st for st in log.fs.listStatus(log.path(log.table)) if "tail=" in st.getPath().getName()]) == 2
    assert spark.read.parquet(f"{log.table}/{head.live['tail']}").count() == 999
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 18


def test_stored_index_is_built_once_per_snapshot_version(spark, tmp_dir, monkeypatch):
    from fleetcast.operators import spatial
    built = []
    real = spatial.build_index
    monkeypatch.setattr(spatial, "build_index", lambda *a, **k: built.append(1) or real(*a, **k))
    rows = [(f"d{i}", 40.7 + i / 1000, -74.0, T0 + dt.timedelta(minutes=i)) for i in range(40)]
    snap = spark.createDataFrame(rows, "driver_id string, lat double, lon double, event_ts timestamp_ntz")
    root = f"{tmp_dir}/online"
    store.upsert_online(snap, root, "driver_status", ["driver_id"])
    for _ in range(3):
        index = jobs.stored_index(spark, root, FIXTURE_RANKER)
    assert len(built) == 1 and index.n_drivers == 40
    store.upsert_online(snap.limit(1).withColumn("event_ts", F.lit(T0 + dt.timedelta(days=1))), root, "driver_status", ["driver_id"])
    jobs.stored_index(spark, root, FIXTURE_RANKER)
    assert len(built) == 2
    # Old positions expire without a new index; the answers are those of the drivers that are left.
    from fleetcast.operators.match import match_top_k
    req = spark.createDataFrame([("q", 40.7, -74.0, 3), ("far", -40.0, 100.0, 2)],
                                "request_id string, rider_lat double, rider_lon double, top_k int")
    got = match_top_k(req, None, FIXTURE_RANKER, index=index, expiry=spatial.Expiry(T0 + dt.timedelta(minutes=30)))
    assert {(r["request_id"], r["rank"]): r["driver_id"] for r in got.collect()} == {
        ("q", 1): "d30", ("q", 2): "d31", ("q", 3): "d32", ("far", 1): "d30", ("far", 2): "d31"}
