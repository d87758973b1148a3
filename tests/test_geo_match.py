"""Haversine, validation and the exact grid top-k against brute force."""

import math
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetcast.functions.geo import haversine_km
from fleetcast.functions.scoring import FIXTURE_RANKER, Ranker, sigmoid
from fleetcast.operators import match as mt
from fleetcast.operators import spatial


def py_haversine(a1, o1, a2, o2):
    p1, p2 = math.radians(a1), math.radians(a2)
    dp, dl = p2 - p1, math.radians(o2) - math.radians(o1)
    a = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(a))


def test_haversine_matches_formula(spark):
    pts = [(40.7128, -74.006, 40.73, -73.99), (0.0, 179.9, 0.0, -179.9), (51.5, 0.0, 48.85, 2.35)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    for g, p in zip(got, pts):
        assert g == pytest.approx(py_haversine(*p), rel=1e-12)


def test_validate_requests(spark):
    df = spark.createDataFrame(
        [("r1", "u1", 40.7, -74.0, None), ("r2", "u2", 40.7, -74.0, 0), ("r3", None, 40.7, -74.0, 3),
         ("r4", "u4", None, -74.0, 2)],
        "request_id string, rider_id string, rider_lat double, rider_lon double, top_k int")
    rows = {r["request_id"]: (r["top_k"], r["error_type"]) for r in mt.validate_requests(df).collect()}
    assert rows == {"r1": (5, None), "r2": (0, "invalid_top_k"), "r3": (3, "missing_rider_id"),
                    "r4": (2, "missing_location")}


def brute_force(requests, drivers, ranker):
    out = {}
    for rid, lat, lon, k in requests:
        scored = []
        for did, dlat, dlon, acc, resp in drivers:
            d = py_haversine(lat, lon, dlat, dlon)
            acc = 0.74 if acc is None else acc
            resp = 850.0 if resp is None else resp
            logit = ranker.intercept + ranker.weights["distance_km"] * d + \
                ranker.weights["accept_rate_7d"] * acc + ranker.weights["avg_response_ms"] * resp
            e = math.exp(-logit) if -logit < 709 else math.inf   # IEEE overflow, like the JVM
            scored.append((-1 / (1 + e), did))
        scored.sort()
        out[rid] = [d for _, d in scored[:k]]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_grid_top_k_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    drivers = []
    for i in range(300):
        if i < 100:   # a dense cluster holding a third of all drivers
            lat, lon = 40.75 + rnd.uniform(-0.001, 0.001), -73.98 + rnd.uniform(-0.001, 0.001)
        else:
            lat, lon = 40.7 + rnd.uniform(-0.05, 0.05), -74.0 + rnd.uniform(-0.05, 0.05)
        acc = None if i % 17 == 0 else rnd.uniform(0.5, 0.99)
        drivers.append((f"d{i:03d}", lat, lon, acc, float(rnd.randint(200, 1500))))
    requests = [(f"q{j}", 40.7 + rnd.uniform(-0.3, 0.3), -74.0 + rnd.uniform(-0.3, 0.3), rnd.randint(1, 12))
                for j in range(120)]
    requests.append(("far", 10.0, 100.0, 3))            # far from every driver
    requests.append(("all", 40.7, -74.0, 400))           # asks for more than exist
    ddf = spark.createDataFrame(drivers, "driver_id string, lat double, lon double, accept_rate_7d double, "
                                         "avg_response_ms double")
    rdf = spark.createDataFrame(requests, "request_id string, rider_lat double, rider_lon double, top_k int")
    got = {}
    for r in mt.match_top_k(rdf, ddf, FIXTURE_RANKER).orderBy("request_id", "rank").collect():
        got.setdefault(r["request_id"], []).append(r["driver_id"])
    want = brute_force(requests, drivers, FIXTURE_RANKER)
    assert got == want


def test_grid_rejects_non_decreasing_distance_weight(spark):
    r = Ranker(0.0, {"distance_km": 0.1, "accept_rate_7d": 0.0, "avg_response_ms": 0.0})
    d = spark.createDataFrame([("d", 1.0, 1.0, 0.5, 500.0)], "driver_id string, lat double, lon double, "
                              "accept_rate_7d double, avg_response_ms double")
    q = spark.createDataFrame([("q", 1.0, 1.0, 1)], "request_id string, rider_lat double, rider_lon double, top_k int")
    with pytest.raises(ValueError):
        mt.match_top_k(q, d, r)


def test_nested_response_keeps_empty_requests(spark):
    flat = spark.createDataFrame([("q1", 2, "b", 0.5, 1.0), ("q1", 1, "a", 0.9, 0.5)],
                                 "request_id string, rank int, driver_id string, score double, distance_km double")
    reqs = spark.createDataFrame([("q1",), ("q2",)], "request_id string")
    rows = {r["request_id"]: r["matches"] for r in mt.keep_empty_requests(reqs, mt.nest_matches(flat)).collect()}
    assert [m["driver_id"] for m in rows["q1"]] == ["a", "b"]
    assert rows["q2"] == []


def test_grid_top_k_with_colocated_drivers(spark):
    # 400 drivers on one exact spot plus a few elsewhere; ties in static score too.
    rnd = random.Random(5)
    drivers = [(f"h{i:03d}", 40.75, -73.98, 0.5 + (i % 5) / 10, 500.0) for i in range(400)]
    drivers += [(f"o{i}", 40.7 + rnd.uniform(-0.05, 0.05), -74.0 + rnd.uniform(-0.05, 0.05),
                 rnd.uniform(0.5, 0.99), 800.0) for i in range(30)]
    requests = [(f"q{j}", 40.75 + rnd.uniform(-0.05, 0.05), -73.98 + rnd.uniform(-0.05, 0.05),
                 rnd.randint(1, 9)) for j in range(60)]
    ddf = spark.createDataFrame(drivers, "driver_id string, lat double, lon double, accept_rate_7d double, "
                                         "avg_response_ms double")
    rdf = spark.createDataFrame(requests, "request_id string, rider_lat double, rider_lon double, top_k int")
    got = {}
    for r in mt.match_top_k(rdf, ddf, FIXTURE_RANKER).orderBy("request_id", "rank").collect():
        got.setdefault(r["request_id"], []).append(r["driver_id"])
    assert got == brute_force(requests, drivers, FIXTURE_RANKER)


def test_grid_top_k_shuffle_join_path(spark):
    # Force the non-broadcast plan (shuffle join on the cell key).
    rnd = random.Random(3)
    drivers = [(f"d{i}", 40.7 + rnd.uniform(-0.05, 0.05), -74 + rnd.uniform(-0.05, 0.05),
                rnd.uniform(0.5, 1), 700.0) for i in range(200)]
    reqs = [(f"q{j}", 40.7 + rnd.uniform(-0.2, 0.2), -74 + rnd.uniform(-0.2, 0.2), rnd.randint(1, 8))
            for j in range(80)]
    ddf = spark.createDataFrame(drivers, "driver_id string, lat double, lon double, accept_rate_7d double, "
                                         "avg_response_ms double")
    rdf = spark.createDataFrame(reqs, "request_id string, rider_lat double, rider_lon double, top_k int")
    got = {}
    for r in mt.match_top_k(rdf, ddf, FIXTURE_RANKER, broadcast_rows=0).orderBy("request_id", "rank").collect():
        got.setdefault(r["request_id"], []).append(r["driver_id"])
    assert got == brute_force(reqs, drivers, FIXTURE_RANKER)


def test_grid_top_k_empty_inputs(spark):
    dschema = "driver_id string, lat double, lon double, accept_rate_7d double, avg_response_ms double"
    rschema = "request_id string, rider_lat double, rider_lon double, top_k int"
    d = spark.createDataFrame([("d1", 40.7, -74.0, 0.9, 300.0), ("d2", 40.71, -74.0, 0.8, 400.0)], dschema)
    r = spark.createDataFrame([("q1", 40.7, -74.0, 5)], rschema)
    assert mt.match_top_k(spark.createDataFrame([], rschema), d, FIXTURE_RANKER).count() == 0
    assert mt.match_top_k(r, spark.createDataFrame([], dschema), FIXTURE_RANKER).count() == 0
    # fewer drivers than requested: every driver, ranked
    assert [x["driver_id"] for x in mt.match_top_k(r, d, FIXTURE_RANKER).orderBy("rank").collect()] == ["d1", "d2"]


def test_score_bounds_hold_for_points_of_a_box(spark):
    """The exact score of every point of a box lies between the bounds (poles, antimeridian, tiny boxes included)."""
    df = spark.range(200_000).select(
        (F.rand(2) * 180 - 90).alias("rider_lat"), (F.rand(3) * 360 - 180).alias("rider_lon"),
        F.pow(F.lit(10.0), F.rand(4) * 6 - 4).alias("size"), (F.rand(5) < 0.5).alias("near"), F.rand(6).alias("u"),
        F.rand(7).alias("v"), F.rand(8).alias("x"), F.rand(9).alias("y"))
    a0 = F.when(F.col("near"), F.col("rider_lat") + (F.col("x") - 0.5) * 3 * F.col("size")).otherwise(F.col("x") * 180 - 90)
    o0 = F.when(F.col("near"), F.col("rider_lon") + (F.col("y") - 0.5) * 3 * F.col("size")).otherwise(F.col("y") * 360 - 180)
    df = df.withColumn("a0", F.least(F.greatest(a0, F.lit(-90.0)), F.lit(90.0))) \
        .withColumn("a1", F.least(F.col("a0") + F.col("size"), F.lit(90.0))) \
        .withColumn("o0", F.least(F.greatest(o0, F.lit(-180.0)), F.lit(180.0))) \
        .withColumn("o1", F.least(F.col("o0") + F.col("size") * 2, F.lit(180.0))) \
        .withColumn("lat", F.col("a0") + F.col("u") * (F.col("a1") - F.col("a0"))) \
        .withColumn("lon", F.col("o0") + F.col("v") * (F.col("o1") - F.col("o0"))) \
        .withColumn("g0", F.lit(0.1)).withColumn("g1", F.lit(0.4)).withColumn("g", F.lit(0.1) + F.col("u") * 0.3)
    slow = Ranker(0.5, {"distance_km": -0.001, "accept_rate_7d": 0.0, "avg_response_ms": 0.0})  # nothing saturates
    df = df.withColumns(spatial.cosines(F.col))
    worst, best = spatial.score_bounds(F.col("rider_lat"), F.col("rider_lon"), slow, F.col)
    exact = sigmoid(F.lit(0.5) - F.lit(0.001) * haversine_km("rider_lat", "rider_lon", "lat", "lon") + F.col("g"))
    assert df.where((exact < worst) | (exact > best)).count() == 0
    # They are of use, too: for small boxes nearby they lie close together.
    assert df.where("near and size < 0.01").where(best - worst > 0.08).count() == 0


def test_grid_top_k_antimeridian_and_pole(spark):
    rnd = random.Random(21)
    drivers = [(f"w{i}", rnd.uniform(-0.5, 0.5), 179.6 + rnd.uniform(0, 0.4), rnd.uniform(0.5, 1), 600.0)
               for i in range(40)]
    drivers += [(f"e{i}", rnd.uniform(-0.5, 0.5), -180 + rnd.uniform(0, 0.4), rnd.uniform(0.5, 1), 600.0)
                for i in range(40)]
    drivers += [(f"n{i}", 89.5 + rnd.uniform(0, 0.49), rnd.uniform(-180, 180), rnd.uniform(0.5, 1), 600.0)
                for i in range(40)]
    requests = [(f"a{j}", rnd.uniform(-0.3, 0.3), rnd.choice([179.9, -179.9]), rnd.randint(1, 6)) for j in range(30)]
    requests += [(f"p{j}", 89.8, rnd.uniform(-180, 180), rnd.randint(1, 6)) for j in range(20)]
    ddf = spark.createDataFrame(drivers, "driver_id string, lat double, lon double, accept_rate_7d double, "
                                         "avg_response_ms double")
    rdf = spark.createDataFrame(requests, "request_id string, rider_lat double, rider_lon double, top_k int")
    got = {}
    for r in mt.match_top_k(rdf, ddf, FIXTURE_RANKER).orderBy("request_id", "rank").collect():
        got.setdefault(r["request_id"], []).append(r["driver_id"])
    assert got == brute_force(requests, drivers, FIXTURE_RANKER)


def test_match_with_saturated_scores_and_odd_requests(spark):
    """Equal scores after saturation go by id; a request delivered twice is one; NaN positions are missing."""
    drivers = spark.createDataFrame(
        [(f"d{i}", 0.0, 0.0, 0.5 + i / 20, 300.0) for i in range(6)] + [("nan", float("nan"), 0.0, 0.9, 1.0)],
        "driver_id string, lat double, lon double, accept_rate_7d double, avg_response_ms double")
    reqs = spark.createDataFrame(
        [("far", "u", 0.0, 140.0, 2), ("near", "u", 0.0, 0.1, 3), ("near", "u", 0.0, 0.1, 3), ("all", "u", 0.0, 0.1, 500),
         ("nan", "u", float("nan"), 0.0, 1)],
        "request_id string, rider_id string, rider_lat double, rider_lon double, top_k int")
    got = {}
    for r in mt.match_drivers(reqs, drivers, FIXTURE_RANKER).orderBy("request_id", "rank").collect():
        got.setdefault(r["request_id"], []).append(r["driver_id"])
    assert got == {"far": ["d0", "d1"], "near": ["d5", "d4", "d3"], "all": ["d5", "d4", "d3", "d2", "d1", "d0"]}
    errors = {r["request_id"]: r["error_type"] for r in mt.rejected_requests(reqs).collect()}
    assert errors == {"nan": "missing_location"}


OWN = ["request_id", "rider_lat", "rider_lon", "_k"]


def pairs_formed(requests, index):
    k = F.least("top_k", F.lit(index.n_drivers)).alias("_k")
    asked = requests.select("request_id", "rider_lat", "rider_lon", k)
    return spatial.pairs(asked, OWN, index, FIXTURE_RANKER).groupBy("request_id").count().withColumnRenamed("count", "n")


def test_pairs_stay_few_also_beside_one_huge_top_k(spark):
    """Below a tenth of all pairs on the test tables; one request that asks for all widens nobody else's search."""
    from paths import SF_MID

    from fleetcast.operators.latest import latest_per_key
    from fleetcast.plans import fixtures as fx
    ev = fx.load_table(spark, SF_MID, "events")
    index = spatial.build_index(mt.drop_unlocated(latest_per_key(fx.driver_events(ev))), FIXTURE_RANKER)
    requests = mt.valid_requests(fx.rider_requests(ev))
    n = requests.count()
    plain = {r["request_id"]: r["n"] for r in pairs_formed(requests, index).collect()}
    assert len(plain) == n and sum(plain.values()) < 0.1 * n * index.n_drivers
    one = min(plain)
    huge = requests.withColumn("top_k", F.when(F.col("request_id") == one, 1_000_000).otherwise(F.col("top_k")))
    beside = {r["request_id"]: r["n"] for r in pairs_formed(huge, index).collect()}
    assert beside.pop(one) == index.n_drivers
    plain.pop(one)
    assert beside == plain


def test_hot_spots_are_searched_by_rank(spark):
    """A third of the drivers on one spot with one static score, a third on another with many."""
    rnd = random.Random(9)
    drivers = [(f"a{i:04d}", 40.7, -74.0, 0.8, 500.0) for i in range(1500)]
    drivers += [(f"b{i:04d}", 40.71, -74.01, 0.5 + rnd.random() / 2, 500.0) for i in range(1500)]
    drivers += [(f"c{i:04d}", 40.7 + rnd.uniform(-0.05, 0.05), -74.0 + rnd.uniform(-0.05, 0.05), 0.7, 500.0)
                for i in range(1500)]
    drivers += [(f"n{i}", 40.7, -74.0, None, None) for i in range(5)]
    requests = [(f"q{j}", 40.7 + rnd.uniform(-0.02, 0.02), -74.0 + rnd.uniform(-0.02, 0.02), rnd.randint(1, 7))
                for j in range(40)] + [("many", 40.7, -74.0, 2000)]
    ddf = spark.createDataFrame(drivers, "driver_id string, lat double, lon double, accept_rate_7d double, "
                                         "avg_response_ms double")
    rdf = spark.createDataFrame(requests, "request_id string, rider_lat double, rider_lon double, top_k int")
    index = spatial.build_index(ddf, FIXTURE_RANKER)
    got = {}
    for r in mt.match_top_k(rdf, None, FIXTURE_RANKER, index=index).orderBy("request_id", "rank").collect():
        got.setdefault(r["request_id"], []).append(r["driver_id"])
    assert got == brute_force(requests, drivers, FIXTURE_RANKER)
    met = {r["request_id"]: r["n"] for r in pairs_formed(rdf.where("top_k < 100"), index).collect()}
    assert max(met.values()) < 150


def test_stored_index_answers_as_the_fresh_one(spark, tmp_dir):
    rnd = random.Random(4)
    drivers = [(f"d{i}", 40.7 + rnd.uniform(-0.05, 0.05), -74 + rnd.uniform(-0.05, 0.05), rnd.uniform(0.5, 1), 700.0)
               for i in range(500)]
    ddf = spark.createDataFrame(drivers, "driver_id string, lat double, lon double, accept_rate_7d double, "
                                         "avg_response_ms double")
    rdf = spark.createDataFrame([(f"q{j}", 40.66, -74.04 + j / 1000, 3) for j in range(20)],
                                "request_id string, rider_lat double, rider_lon double, top_k int")
    index = spatial.build_index(ddf, FIXTURE_RANKER)
    index.save(f"{tmp_dir}/index")
    stored = spatial.DriverIndex.load(spark, f"{tmp_dir}/index")
    want = mt.match_top_k(rdf, None, FIXTURE_RANKER, index=index).collect()
    assert sorted(mt.match_top_k(rdf, None, FIXTURE_RANKER, index=stored).collect()) == sorted(want)
    cells = index.drivers.withColumn("part", spatial.part_of(F.col("cell"))).groupBy("part").agg(
        F.min("lat").alias("a"), F.max("lat").alias("b"), F.min("lon").alias("c"), F.max("lon").alias("d")).collect()
    assert len(cells) == 16 and all(r["b"] - r["a"] < 0.026 and r["d"] - r["c"] < 0.026 for r in cells)


def test_cells_met_do_not_grow_with_the_drivers(spark):
    """Static scores part drivers as places do: sixteen times the drivers, about as many pairs a request."""
    def met(n: int) -> float:
        ddf = spark.range(n).select(
            F.concat(F.lit("d"), "id").alias("driver_id"), (40.69 + F.rand(1) * 0.04).alias("lat"),
            (-74.03 + F.rand(2) * 0.04).alias("lon"), (0.5 + F.rand(3) / 2).alias("accept_rate_7d"),
            (200 + F.rand(4) * 1300).alias("avg_response_ms"))
        rdf = spark.range(100).select(F.concat(F.lit("q"), "id").alias("request_id"), (40.66 + F.rand(5) * 0.1).alias("rider_lat"),
                                      (-74.06 + F.rand(6) * 0.1).alias("rider_lon"), F.lit(5).alias("top_k"))
        return pairs_formed(rdf, spatial.build_index(ddf, FIXTURE_RANKER)).agg(F.avg("n")).first()[0]
    assert met(32_000) < 2 * met(2_000) < 200


def test_stored_index_counts_the_drivers_left(spark):
    """Every cell holds expired drivers: those left are counted all the same, so few are looked at."""
    t0 = dt.datetime(2024, 1, 1)
    ddf = spark.range(4000).select(
        F.concat(F.lit("d"), "id").alias("driver_id"), (40.69 + F.rand(1) * 0.04).alias("lat"),
        (-74.03 + F.rand(2) * 0.04).alias("lon"), (0.5 + F.rand(3) / 2).alias("accept_rate_7d"), F.lit(700.0).alias("avg_response_ms"),
        (F.lit(t0).cast("timestamp_ntz") + F.make_dt_interval(hours=F.when(F.col("id") % 4 == 0, 0).otherwise(20))).alias("position_ts")) \
        .withColumn("features_ts", F.col("position_ts")).localCheckpoint()
    rdf = spark.range(50).select(F.concat(F.lit("q"), "id").alias("request_id"), (40.66 + F.rand(5) * 0.1).alias("rider_lat"),
                                 (-74.06 + F.rand(6) * 0.1).alias("rider_lon"), F.lit(5).alias("top_k")).localCheckpoint()
    after = t0 + dt.timedelta(hours=8)
    index, expiry = spatial.build_index(ddf, FIXTURE_RANKER), spatial.Expiry(after, after)
    asked = rdf.withColumnRenamed("top_k", "_k")
    assert spatial.pairs(asked, asked.columns, index, FIXTURE_RANKER, expiry=expiry).count() < 50 * 150
    left = ddf.where(F.col("position_ts") >= F.lit(after)).drop("position_ts", "features_ts")
    want = mt.match_top_k(rdf, left, FIXTURE_RANKER).collect()
    assert sorted(mt.match_top_k(rdf, None, FIXTURE_RANKER, index=index, expiry=expiry).collect()) == sorted(want)
