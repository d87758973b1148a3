"""Which candidates the histograms and the drift of scored candidates see."""

import datetime as dt

import pytest

import __spark_entry__ as E

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@pytest.fixture()
def tables(spark, tmp_dir):
    """Six drivers, five of them last seen 20 hours before the newest event; 60 requests, two of them with ``top_k`` 0."""
    drivers = [(1000 + i, T0 + dt.timedelta(hours=20 if i == 0 else 0), i, "click", 1.0, "{}") for i in range(6)]
    requests = [(i, T0 + dt.timedelta(hours=19, minutes=i), i, "signup", 1.0, "{}") for i in range(30, 90)]
    spark.createDataFrame(drivers + requests, SCHEMA).write.parquet(f"{tmp_dir}/events.parquet")
    return tmp_dir, sum(min(5 + i % 6, 6) for i in range(30, 90))


def test_histograms_see_candidates_of_all_requests_and_drivers(spark, tables):
    sf_dir, scored = tables
    run = E.queries()
    assert {r["count"] for r in run["score_histogram"](spark, sf_dir).collect()} == {scored}
    by_le = run["feature_sum_by_le"](spark, sf_dir).where("le = double('inf')").agg({"bucket_count": "sum"}).first()[0]
    assert by_le == 3 * scored


@pytest.mark.parametrize("name", ["drift_score", "drift_status", "stream_drift"])
def test_drift_sees_candidates_of_all_requests_and_drivers(spark, tables, name):
    sf_dir, scored = tables
    got = E.queries()[name](spark, sf_dir).groupBy("feature_name").agg({"observations": "max"}).collect()
    assert {r[0]: r[1] for r in got} == dict.fromkeys(("distance_km", "accept_rate_7d", "avg_response_ms"), scored // 100 * 100)


def test_drift_over_several_stretches_in_two_batches(spark, tmp_dir, monkeypatch):
    """More checkpoints than one stretch has, the state of the first batch carried on; nothing goes through one task."""
    import numpy as np
    from pyspark.sql import functions as F
    from pyspark.sql.classic.dataframe import DataFrame

    from fleetcast.streaming import jobs

    base = spark.createDataFrame([("f", 0.5)], "feature_name string, p95 double")
    obs = spark.range(24_050).select(F.lit("f").alias("feature_name"), F.col("id").alias("seq"),
                                     (F.pmod(F.hash("id"), F.lit(997)) / 997).alias("value")).localCheckpoint()
    values = np.array([r["value"] for r in obs.orderBy("seq").collect()])

    def refuse(self, n):
        raise AssertionError("one task would read the whole batch")
    monkeypatch.setattr(DataFrame, "coalesce", refuse)
    for n, part in enumerate((obs.where("seq < 11030"), obs.where("seq >= 11030"))):
        part.write.parquet(f"{tmp_dir}/obs/half={n}")
        stream = spark.readStream.schema(obs.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/obs")
        jobs.stream_drift(stream, base, f"{tmp_dir}/state", f"{tmp_dir}/out", f"{tmp_dir}/ck", ["seq"]).awaitTermination()
    got = {r["observations"]: (r["window_size"], r["current_p95"]) for r in spark.read.parquet(f"{tmp_dir}/out/batch_id=*").collect()}
    assert sorted(got) == list(range(100, 24_001, 100))
    for c, (size, p95) in got.items():
        assert size == min(c, 1000) and abs(p95 - np.percentile(values[max(c - 1000, 0):c], 95)) < 1e-12
