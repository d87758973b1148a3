"""Ranker fit equals the C = 1 L2 logistic objective; persistence and guards."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetcast.operators import model as md
from fleetcast.operators import match as mt
from fleetcast.operators.quality import all_null_guard


def newton_l2_logreg(X, y, c=1.0, iters=50):
    """Minimise 0.5*||w||^2 + C * sum(logloss) (intercept not penalised)."""
    Xb = np.hstack([np.ones((len(X), 1)), X])
    w = np.zeros(Xb.shape[1])
    reg = np.eye(Xb.shape[1]) / c
    reg[0, 0] = 0.0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-Xb @ w))
        g = Xb.T @ (p - y) + reg @ w
        H = Xb.T @ (Xb * (p * (1 - p))[:, None]) + reg
        w -= np.linalg.solve(H, g)
    return w


def test_fit_matches_l2_objective(spark):
    rng = np.random.default_rng(7)
    n = 400
    d = rng.uniform(0, 5, n)
    a = rng.uniform(0.5, 1.0, n)
    r = rng.uniform(200, 1500, n)
    logit = 1.5 - 1.2 * d + 0.8 * a - 0.0005 * r
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-logit))).astype(float)
    rows = [(float(d[i]), float(a[i]), float(r[i]), int(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "distance_km double, accept_rate_7d double, avg_response_ms double, label int")
    ranker, _ = md.fit_ranker(df)
    w = newton_l2_logreg(np.column_stack([d, a, r]), y)
    got = [ranker.intercept, ranker.weights["distance_km"], ranker.weights["accept_rate_7d"],
           ranker.weights["avg_response_ms"]]
    assert np.allclose(got, w, rtol=1e-3, atol=1e-5)
    m = md.evaluate_ranker(md.score_rows(df, ranker))
    assert 0.5 < m["auc"] <= 1.0 and 0 <= m["accuracy"] <= 1


def test_train_ranker_writes_stats_model_and_run(spark, tmp_dir):
    from fleetcast.plans.catalog import _training
    from fleetcast.sources.online_store import read_stats

    ranker, metrics, _ = md.train_ranker(_training(spark, "/root/testdata/sf0.001"),
                                         stats_path=f"{tmp_dir}/stats", model_path=f"{tmp_dir}/model",
                                         runs_path=f"{tmp_dir}/runs")
    assert set(metrics) == {f"{s}_{m}" for s in ("train", "val") for m in ("auc", "accuracy", "log_loss")}
    assert ranker.weights["distance_km"] < 0          # nearest drivers are the positives
    assert read_stats(spark, f"{tmp_dir}/stats").count() == 3
    assert md.load_ranker(spark, f"{tmp_dir}/model") == ranker
    assert md.load_pipeline(f"{tmp_dir}/model") is not None
    assert spark.read.parquet(f"{tmp_dir}/runs").count() == 1


def test_candidate_pool_and_null_guard(spark):
    pool = mt.candidate_pool(spark, 100)
    ids = {r[0] for r in pool.collect()}
    assert len(ids) == 100 and "driver_0" in ids and "driver_99" in ids
    nulls = spark.createDataFrame([(None, None), (None, None)], "lat double, lon double")
    with pytest.raises(RuntimeError):
        all_null_guard(nulls)
    all_null_guard(nulls.union(spark.createDataFrame([(1.0, None)], "lat double, lon double")))
