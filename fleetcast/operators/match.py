"""Request validation, candidate search, scoring and top-k.

Ranking every request against every driver is a cross product, which does not
scale.  ``match_top_k`` returns the *same* top-k exactly: a branch and bound over
a summary of the drivers (``spatial``) leaves each request with the few cells
that can hold one of its best, and only their drivers are scored.  The bounds
hold because the score is monotone in
``intercept + w_dist * distance + g(driver)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetcast.functions.frames import with_group_index
from fleetcast.functions.geo import haversine_km
from fleetcast.functions.scoring import Ranker, sigmoid
from fleetcast.operators.latest import expire
from fleetcast.operators.quality import missing_counts
from fleetcast.operators.spatial import BROADCAST_ROWS, DriverIndex, Expiry, all_tied, build_index, drivers_at, pairs

DEFAULT_TOP_K = 5


# ---------------------------------------------------------------- validation

def _located(lat: str, lon: str) -> Column:
    """Both coordinates are numbers (NaN is not)."""
    return F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


def validate_requests(requests: DataFrame, default_top_k: int = DEFAULT_TOP_K) -> DataFrame:
    """Fill ``top_k`` with the default and label invalid rows in ``error_type``.

    A NaN position is a missing one.
    """
    k = F.coalesce(F.col("top_k").cast("int"), F.lit(default_top_k))
    err = (F.when(F.col("request_id").isNull(), F.lit("missing_request_id"))
           .when(F.col("rider_id").isNull(), F.lit("missing_rider_id"))
           .when(~_located("rider_lat", "rider_lon"), F.lit("missing_location"))
           .when(k < 1, F.lit("invalid_top_k")))
    return requests.withColumn("top_k", k).withColumn("error_type", err)


def valid_requests(requests: DataFrame, default_top_k: int = DEFAULT_TOP_K) -> DataFrame:
    return validate_requests(requests, default_top_k).where(F.col("error_type").isNull()).drop("error_type")


def rejected_requests(requests: DataFrame, default_top_k: int = DEFAULT_TOP_K) -> DataFrame:
    return validate_requests(requests, default_top_k).where(F.col("error_type").isNotNull())


def drop_unlocated(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Candidates without a position cannot be scored."""
    return df.where(_located(lat, lon))


def candidate_pool(spark, n: int, prefix: str = "driver_") -> DataFrame:
    """The fixed pool ``driver_0 … driver_{n-1}`` as a distributed range."""
    return spark.range(n).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("driver_id"))


# --------------------------------------------------------------- top-k search

def match_top_k(requests: DataFrame, drivers: DataFrame | None, ranker: Ranker, request_partitions: int | None = None,
                carry=(), index: DriverIndex | None = None, expiry: Expiry = Expiry(),
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """K1: the ``top_k`` best drivers per request, exactly, without forming all pairs.

    ``requests``: request_id, rider_lat, rider_lon, top_k (already validated).
    ``drivers``: driver_id, lat, lon (not null) and the ranker's other features;
    or their ``index``, built before for the same ranker, of which ``expiry``
    leaves out what is too old.
    Output: request_id, rank, driver_id, distance_km, score, the driver
    features and the request columns named in ``carry``; at most ``top_k``
    rows per request, ranked by score desc then driver_id.
    """
    carry = list(carry)
    if float(ranker.weights["distance_km"]) >= 0:
        raise ValueError("the search needs a ranker whose score falls with distance (w_distance < 0)")
    feats = [f for f in ranker.features if f != "distance_km"]
    index = index or build_index(drivers, ranker)
    if not index.n_drivers:
        return _empty_result(requests, feats, carry)
    parts = request_partitions or int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Requests that share an id but not their content are ranked apart.
    own = ["request_id", "rider_lat", "rider_lon", "_k", *carry]
    most = F.least(F.col("top_k"), F.lit(index.n_drivers)).alias("_k")
    asked = requests.select("request_id", "rider_lat", "rider_lon", most, *carry) \
        .repartition(parts, "request_id").dropDuplicates()  # the topic may deliver a request twice
    out = ["request_id", "rank", "driver_id", "distance_km", "score", *feats, *carry]
    tied = all_tied(index, ranker)
    found = pairs(asked.where(~tied), own, index, ranker, broadcast_rows, expiry)
    ranked = _ranked(found, own, feats, ranker).select(*out)
    if requests.where(tied).isEmpty():
        return ranked
    # So far away that all drivers score alike: the first ids are the answer.
    places = with_group_index(drivers_at(index, ranker, expiry).drop("cell", "part"), ["driver_id"], name="_place")
    first = asked.where(tied).withColumn("_floor", F.lit(None).cast("double")) \
        .withColumn("_place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k").cast("long") - 1)))
    return ranked.unionByName(_ranked(first.join(places, "_place"), own, feats, ranker).select(*out))


def _ranked(pairs: DataFrame, own: list[str], feats: list[str], ranker: Ranker) -> DataFrame:
    """Scored pairs, the ``_k`` best of each request."""
    dist = haversine_km(F.col("rider_lat"), F.col("rider_lon"), F.col("lat"), F.col("lon"))
    base = [*own, "_floor", "driver_id", *feats]
    # Distance and score are produced by Generates (``inline``): the floor
    # filter below cannot be pushed under them, so each pair's trigonometry
    # runs once instead of once per expression that reads the score.
    scored = pairs.select(*base, F.inline(F.array(F.struct(dist.alias("distance_km")))))
    scored = scored.select(*base, "distance_km", F.inline(F.array(F.struct(
        sigmoid(ranker.logit({"distance_km": F.col("distance_km")})).alias("score")))))
    # Pairs below the floor cannot reach the top k (k candidates already beat it).
    scored = scored.where(F.col("_floor").isNull() | F.col("score").isNull() | (F.col("score") >= F.col("_floor")))
    w = Window.partitionBy(*own).orderBy(F.col("score").desc_nulls_last(), F.col("driver_id").asc())
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.col("_k"))


def _empty_result(req: DataFrame, feats, carry=()) -> DataFrame:
    return req.select("request_id", F.lit(None).cast("int").alias("rank"),
                      F.lit(None).cast("string").alias("driver_id"),
                      F.lit(None).cast("double").alias("distance_km"),
                      F.lit(None).cast("double").alias("score"),
                      *[F.lit(None).cast("double").alias(f) for f in feats], *carry).where(F.lit(False))


# ----------------------------------------------------------- response shapes

def nest_matches(flat: DataFrame) -> DataFrame:
    """K2: one row per request with ``matches`` = ordered list of (driver_id, score, distance_km)."""
    item = F.struct(F.col("rank"), F.col("driver_id"), F.col("score"), F.col("distance_km"))
    return (flat.groupBy("request_id")
            .agg(F.array_sort(F.collect_list(item)).alias("_m"))
            .select("request_id", F.transform("_m", lambda x: F.struct(
                x["driver_id"].alias("driver_id"), x["score"].alias("score"),
                x["distance_km"].alias("distance_km"))).alias("matches")))


def keep_empty_requests(requests: DataFrame, nested: DataFrame) -> DataFrame:
    """K3: requests without a located candidate get an empty list."""
    empty = F.array().cast("array<struct<driver_id:string,score:double,distance_km:double>>")
    return (requests.select("request_id").join(nested, "request_id", "left")
            .select("request_id", F.coalesce(F.col("matches"), empty).alias("matches")))


def match_responses(requests: DataFrame, snapshot: DataFrame | None, ranker: Ranker,
                    default_top_k: int = DEFAULT_TOP_K, index: DriverIndex | None = None,
                    expiry: Expiry = Expiry()) -> DataFrame:
    """K2 + K3: one row per request, ``matches`` ordered and maybe empty, ``error_type`` of rejected ones.

    Candidates come from a snapshot, or from an ``index`` built before.
    """
    checked = validate_requests(requests, default_top_k)
    if index is None:
        flat = match_drivers(requests, snapshot, ranker, default_top_k=default_top_k)
    else:
        flat = match_top_k(valid_requests(requests, default_top_k), None, ranker, index=index, expiry=expiry)
    nested = nest_matches(flat)
    answered = keep_empty_requests(checked.where(F.col("error_type").isNull()).dropDuplicates(["request_id"]), nested) \
        .withColumn("error_type", F.lit(None).cast("string"))
    kind = answered.schema["matches"].dataType
    rejected = checked.where(F.col("error_type").isNotNull()).select(
        "request_id", F.array().cast(kind).alias("matches"), "error_type")
    return answered.unionByName(rejected)


def missing_in_candidates(valid: DataFrame, snapshot: DataFrame, fields, by=()) -> DataFrame:
    """A7 inside Q1: null fields among the candidates that requests fetch, before unlocated ones are dropped.

    Every request fetches the whole snapshot, so a field is missing as often as
    it is null there, times the requests (per ``by`` group): no pairs are formed.
    """
    nulls = missing_counts(snapshot, list(fields))   # one row a field
    asked = valid.dropDuplicates().groupBy(*by).agg(F.count(F.lit(1)).alias("_asked"))
    return asked.withColumn("_n", F.explode(F.array(*[F.lit(f) for f in fields]))) \
        .join(F.broadcast(nulls), F.col("_n") == F.col("feature_name")) \
        .select(*by, "feature_name", (F.col("missing") * F.col("_asked")).alias("missing"))


def match_drivers(requests: DataFrame, snapshot: DataFrame, ranker: Ranker, default_top_k: int = DEFAULT_TOP_K,
                  carry=(), as_of=None, ttl=None, ts: str = "event_ts") -> DataFrame:
    """Q1 (flat form): validate → expire → drop unlocated candidates → exact top-k.

    With ``as_of`` and ``ttl``, features of drivers last seen earlier are null,
    as in the lookup (J4); a driver whose position has expired is no candidate.
    """
    valid = valid_requests(requests, default_top_k)
    if as_of is not None and ttl is not None:
        snapshot = expire(snapshot, as_of, ttl, ["lat", "lon", *[f for f in ranker.features if f != "distance_km"]], ts)
    drivers = drop_unlocated(snapshot)
    return match_top_k(valid, drivers, ranker, carry=carry)
