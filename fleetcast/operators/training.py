"""Training-set construction.

Candidate choice (J7) never ranks all drivers for a request: drivers get a
dense index 0…n-1 (distributed sort + per-partition offsets).  Request r turns
the index by a hash of its own, cuts the whole circle into k strata
``[j*n div k, (j+1)*n div k)`` and takes one driver of each by a second hash:
k distinct drivers, every driver equally likely, via an equi-join on the index.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetcast.functions.frames import cut_lineage, with_group_index
from fleetcast.functions.geo import haversine_km
from fleetcast.functions.hashing import seeded_hash32, seeded_md5
from fleetcast.operators.latest import time_bounds
from fleetcast.operators.quality import exact_quantiles, to_long

SEED = 42


# ------------------------------------------------------------- entity rows

def rename_event_time(df: DataFrame, src: str = "event_ts", dst: str = "event_timestamp") -> DataFrame:
    """P6."""
    return df.withColumnRenamed(src, dst)


def drop_null_keys(df: DataFrame, key: str = "driver_id", ts: str = "event_timestamp") -> DataFrame:
    """Drop rows lacking key or time; key as string; drop empty keys."""
    k = F.col(key).cast("string")
    return df.withColumn(key, k).where(k.isNotNull() & F.col(ts).isNotNull() & (F.length(k) > 0))


def time_range(df: DataFrame, start, end, ts: str = "event_timestamp", require_rows: bool = False) -> DataFrame:
    """``start <= ts <= end``; optionally fail when nothing is left."""
    out = df.where(time_bounds(ts, start, end))
    if require_rows and out.isEmpty():
        raise RuntimeError(f"no rows between {start} and {end}")
    return out


def lookback_window(now: dt.datetime, days: float) -> tuple[dt.datetime, dt.datetime]:
    """``[now - days, now]``; ``now`` is a parameter, never the wall clock."""
    return now - dt.timedelta(days=days), now


def bounded_sample(df: DataFrame, n: int, key_cols, seed: int = SEED) -> DataFrame:
    """At most ``n`` rows, the ones with the smallest seeded hash.

    Same rows under any partitioning; runs as a per-partition top-n plus one
    merge of ``n x partitions`` rows (TakeOrderedAndProject).
    """
    h = seeded_md5(seed, *key_cols)
    return df.withColumn("_h", h).orderBy("_h", *key_cols).limit(n).drop("_h")


def entity_rows(events: DataFrame, start=None, end=None) -> DataFrame:
    """(driver_id, event_timestamp) rows derived from the offline events."""
    e = drop_null_keys(rename_event_time(events.select("driver_id", "event_ts")))
    return time_range(e, start, end) if (start is not None or end is not None) else e


# ------------------------------------------------------------- candidates

def index_drivers(drivers: DataFrame, key: str = "driver_id") -> DataFrame:
    """Dense 0-based index of drivers in key order (distributed)."""
    return with_group_index(drivers, [key], None, "_idx")


def sample_candidates(requests: DataFrame, drivers: DataFrame, k_col: str = "num_candidates",
                      seed: int = SEED, min_drivers: int = 5) -> DataFrame:
    """``k`` distinct drivers per request (k from the request row, at most n).

    Requests without a positive ``k`` have no candidates; see ``rejected_samples``.
    """
    idx = index_drivers(drivers)   # reads a checkpointed, numbered copy; cheap to re-read
    n = idx.count()
    if n < min_drivers:
        raise ValueError(f"need at least {min_drivers} drivers to sample candidates, found {n}")
    k = F.least(F.col(k_col).cast("long"), F.lit(n))
    picks = (requests.where(F.col(k_col) >= 1).withColumn("_k", k)
             .withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1))))
    low, high = F.expr(f"(_j * {n}L) div _k"), F.expr(f"((_j + 1L) * {n}L) div _k")
    at = seeded_hash32(seed, "request_id") + low + F.pmod(seeded_hash32(seed, "request_id", "_j"), high - low)
    return picks.withColumn("_idx", F.pmod(at, F.lit(n).cast("long"))).join(idx, "_idx", "inner").drop("_idx", "_k")


def rejected_samples(requests: DataFrame, k_col: str = "num_candidates") -> DataFrame:
    """Requests that ``sample_candidates`` leaves out, with ``error_type``."""
    reason = F.when(F.col(k_col).isNull(), F.lit("missing_num_candidates")) \
        .when(F.col(k_col) < 1, F.lit("invalid_num_candidates"))
    return requests.withColumn("error_type", reason).where(reason.isNotNull())


def label_nearest(pairs: DataFrame, rider_lat: str = "rider_lat", rider_lon: str = "rider_lon") -> DataFrame:
    """P13 + A5: distance per pair; the nearest driver of each request gets label 1.

    Ties go to the smaller driver_id; pairs without a distance are dropped
    first (a missing position cannot be nearest).
    """
    d = pairs.withColumn("distance_km", haversine_km(rider_lat, rider_lon, "lat", "lon")) \
        .where(F.col("distance_km").isNotNull())
    w = Window.partitionBy("request_id").orderBy("distance_km", "driver_id")
    return d.withColumn("label", (F.row_number().over(w) == 1).cast("int"))


def training_set(driver_events: DataFrame, requests: DataFrame, views, start=None, end=None,
                 max_entity_rows: int | None = None, seed: int = SEED) -> DataFrame:
    """Q2: entity rows → as-of join → guard → latest per driver → candidates → labels."""
    from fleetcast.operators.asof import multi_view_join
    from fleetcast.operators.latest import latest_per_key
    from fleetcast.operators.quality import all_null_guard

    ent = entity_rows(driver_events, start, end)
    if max_entity_rows is not None:
        ent = bounded_sample(ent, max_entity_rows, ["driver_id", "event_timestamp"], seed)
    # Checkpointed once: the guard reads it, and so does the rest of the plan.
    feats = cut_lineage(multi_view_join(ent, driver_events, views, tiebreak=("event_id",)))
    all_null_guard(feats, ("lat", "lon"))
    latest = latest_per_key(feats, ["driver_id"], "event_timestamp", tiebreak=())
    located = latest.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    pairs = sample_candidates(requests.select("request_id", "rider_lat", "rider_lon", "num_candidates"),
                              located.select("driver_id", "lat", "lon", "accept_rate_7d", "avg_response_ms"),
                              seed=seed)
    return label_nearest(pairs).select("request_id", "driver_id", "distance_km", "accept_rate_7d",
                                       "avg_response_ms", "label")


# ------------------------------------------------------------- split / impute

def stratified_split(df: DataFrame, label: str = "label", key_cols=("request_id", "driver_id"),
                     test_size: float = 0.2, seed: int = SEED) -> DataFrame:
    """M1: per label, the ``ceil(test_size * n_label)`` rows with the smallest hash
    go to ``val``; the rest to ``train``.  Exact sizes, distributed ranking."""
    h = seeded_md5(seed, *key_cols)
    ranked = with_group_index(df.withColumn("_h", h), [F.col("_h"), *key_cols], [label], "_pos")
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    cut = F.ceil(F.col("_n") * F.lit(test_size))
    return (ranked.join(F.broadcast(counts), label)
            .withColumn("split", F.when(F.col("_pos") < cut, F.lit("val")).otherwise(F.lit("train")))
            .drop("_h", "_pos", "_n"))


def fit_medians(train: DataFrame, cols) -> dict[str, float]:
    """M2 (fit): exact medians of each column on the training rows."""
    med = exact_quantiles(to_long(train, cols), {"p50": 0.5}).collect()   # one row per column
    got = {r["feature"]: r["p50"] for r in med}
    missing = [c for c in cols if got.get(c) is None]
    if missing:
        raise ValueError(f"columns with no values to impute from: {missing}")
    return {c: float(got[c]) for c in cols}


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """M2 (apply)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in medians.items()})
