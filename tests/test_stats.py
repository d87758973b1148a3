"""Quantiles, split sizes, candidate sampling, histograms and drift."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetcast.functions.frames import with_group_index
from fleetcast.operators import drift as dr
from fleetcast.operators import metrics as mx
from fleetcast.operators import quality as qa
from fleetcast.operators import training as tr


def test_group_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 5000).alias("v")) \
        .repartition(7)
    rows = with_group_index(df, ["v"], ["g"], "i").collect()
    for g in range(3):
        got = sorted((r["i"], r["v"]) for r in rows if r["g"] == g)
        vs = sorted(r["v"] for r in rows if r["g"] == g)
        assert [i for i, _ in got] == list(range(len(vs)))
        assert [v for _, v in got] == vs


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(5)
    vals = [rnd.gauss(0, 1) for _ in range(1001)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = qa.exact_quantiles(qa.to_long(df, ["x"]), {"p50": 0.5, "p95": 0.95}).first()
    clean = np.array([v for v in vals if v is not None and v == v])
    assert got["p50"] == pytest.approx(np.percentile(clean, 50), abs=1e-12)
    assert got["p95"] == pytest.approx(np.percentile(clean, 95), abs=1e-12)


def test_stratified_split_sizes(spark):
    df = spark.range(0, 1003).select(F.col("id").cast("string").alias("request_id"),
                                     F.lit("d").alias("driver_id"),
                                     (F.col("id") % 7 == 0).cast("int").alias("label"))
    out = tr.stratified_split(df).groupBy("label", "split").count().collect()
    sizes = {(r["label"], r["split"]): r["count"] for r in out}
    n1, n0 = 144, 1003 - 144
    assert sizes[(1, "val")] == -(-n1 * 2 // 10) and sizes[(0, "val")] == -(-n0 * 2 // 10)
    assert sizes[(1, "train")] + sizes[(1, "val")] == n1


def test_sample_candidates_distinct(spark):
    drivers = spark.range(0, 37).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("driver_id"))
    reqs = spark.range(0, 50).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("request_id"),
                                     (F.lit(5) + F.col("id") % 6).cast("int").alias("num_candidates"))
    out = tr.sample_candidates(reqs, drivers)
    per = out.groupBy("request_id").agg(F.count("*").alias("n"), F.countDistinct("driver_id").alias("d")).collect()
    assert len(per) == 50 and all(r["n"] == r["d"] for r in per)
    want = {f"r{i}": 5 + i % 6 for i in range(50)}
    assert {r["request_id"]: r["n"] for r in per} == want


def test_label_nearest_one_positive(spark):
    pairs = spark.createDataFrame(
        [("q", "a", 40.0, -74.0, 40.01, -74.0), ("q", "b", 40.0, -74.0, 40.001, -74.0),
         ("q", "c", 40.0, -74.0, None, -74.0)],
        "request_id string, driver_id string, rider_lat double, rider_lon double, lat double, lon double")
    got = {r["driver_id"]: r["label"] for r in tr.label_nearest(pairs).collect()}
    assert got == {"a": 0, "b": 1}


def test_histogram_and_quantile(spark):
    vals = [0.005, 0.03, 0.07, 0.07, 0.15, 0.3, 0.7, 1.5, 3.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = mx.bucket_histogram(df, "x", mx.LATENCY_BOUNDS)
    cum = {r["le"]: r["bucket_count"] for r in h.collect()}
    assert cum[0.01] == 1 and cum[0.1] == 4 and cum[float("inf")] == 9
    q = mx.histogram_quantile(h, 0.5).first()["quantile"]
    # rank 4.5 falls in (0.1, 0.2] holding 1 obs above cum 4 -> 0.1 + 0.1*0.5
    assert q == pytest.approx(0.15)
    q99 = mx.histogram_quantile(h, 0.99).first()["quantile"]
    assert q99 == 2.0   # +Inf bucket -> highest finite bound


def test_drift_matches_rolling_numpy(spark):
    rnd = random.Random(9)
    rows = [("f", i, rnd.uniform(0, 10)) for i in range(2350)] + [("g", i, 1.0) for i in range(250)]
    obs = spark.createDataFrame(rows, "feature_name string, seq long, value double")
    base = spark.createDataFrame([("f", 9.0), ("g", 0.0)], "feature_name string, p95 double")
    got = {(r["feature_name"], r["observations"]): r["drift"]
           for r in dr.drift_score(obs, base, ["seq"]).collect()}
    assert len(got) == 23 + 2
    for (f, n), d in got.items():
        vals = [v for ff, _, v in rows if ff == f][:n][-1000:]
        cur = np.percentile(vals, 95)
        b = 9.0 if f == "f" else 0.0
        want = abs(cur - b) / b if b else abs(cur - b)
        assert d == pytest.approx(want, abs=1e-12)


def test_drift_status_thresholds(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.19,), (0.2,)], "drift double")
    assert [r["status"] for r in dr.drift_status(df).collect()] == ["green", "yellow", "yellow", "red"]


def test_group_index_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=200, unique=True),
           st.integers(1, 9))
    def check(rows, parts):
        df = spark.createDataFrame(rows, "g int, v int").repartition(parts)
        got = with_group_index(df, ["v"], ["g"], "i").collect()
        for g in {r[0] for r in rows}:
            mine = sorted((r["i"], r["v"]) for r in got if r["g"] == g)
            assert [i for i, _ in mine] == list(range(len(mine)))
            assert [v for _, v in mine] == sorted(v for gg, v in rows if gg == g)

    check()


def test_every_driver_can_be_a_candidate(spark):
    """Also the last n mod k drivers; a request without a positive number gets a reason instead."""
    drivers = spark.range(149).select(F.concat(F.lit("d"), "id").alias("driver_id"))
    reqs = spark.range(3000).select(F.concat(F.lit("r"), "id").alias("request_id"), F.lit(10).alias("num_candidates"))
    got = tr.sample_candidates(reqs, drivers).select("request_id", "driver_id").toPandas()
    assert len(got) == 30000 and len(got.drop_duplicates()) == 30000
    drawn = got.groupby("driver_id").size()
    assert len(drawn) == 149 and drawn.min() > 100 and drawn.max() < 320
    few = tr.sample_candidates(reqs.limit(200).withColumn("num_candidates", F.lit(5)), drivers.limit(9)).toPandas()
    assert few.groupby("request_id").driver_id.apply(lambda x: tuple(sorted(x))).nunique() > 20
    odd = spark.createDataFrame([("a", None), ("b", 0), ("c", 400)], "request_id string, num_candidates int")
    assert {r[0]: r[1] for r in tr.sample_candidates(odd, drivers).groupBy("request_id").count().collect()} == {"c": 149}
    assert {r["request_id"]: r["error_type"] for r in tr.rejected_samples(odd).collect()} == {
        "a": "missing_num_candidates", "b": "invalid_num_candidates"}


def test_quantiles_with_one_value_on_most_rows(spark):
    import numpy as np
    from fleetcast.operators.quality import exact_quantiles
    rng = np.random.default_rng(3)
    v = np.where(rng.random(20000) < 0.9, 5.0, rng.uniform(0, 10, 20000).round(3))
    df = spark.createDataFrame([("a", float(x)) for x in v] + [("b", 1.0), ("b", 2.0), ("b", None), ("b", float("nan"))],
                               "feature string, value double").repartition(6)
    got = {r["feature"]: r for r in exact_quantiles(df, {"p50": 0.5, "p95": 0.95, "p01": 0.01}).collect()}
    for name, q in (("p50", 0.5), ("p95", 0.95), ("p01", 0.01)):
        assert abs(got["a"][name] - np.quantile(v, q)) < 1e-12
        assert abs(got["b"][name] - np.quantile([1.0, 2.0], q)) < 1e-12
