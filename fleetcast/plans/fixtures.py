"""Deterministic fixture views derived from the ``events`` table.

They stand in for the reference's live topic: driver location updates, rider
requests, entity rows for point-in-time lookups and API call records.  Each
view is a pure, row-wise function of ``events`` (no shuffle), so it grows with
the table and both Spark and DuckDB compute identical rows.  ``FIXTURE_SQL``
holds the same definitions as ANSI SQL for the oracle side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; spread it when the scan would under-fill the cluster.

    A table stored as a single row group scans as one task, which would run
    all row-local work of the query serially.  Large tables split into many
    scan tasks and are left as they are (no extra shuffle).
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    want = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        df = df.repartition(want)
    return df


def _id_str(c: str) -> Column:
    return F.col(c).cast("string")


def _coord(base: int, mult: int, mod: int, ident: str = "event_id") -> Column:
    return (F.lit(base) + (F.col(ident) * F.lit(mult)) % F.lit(mod)).cast("double") / F.lit(1000000)


def driver_events(events: DataFrame) -> DataFrame:
    """fx_driver_events: one driver location/metric update per non-signup event."""
    eid = F.col("event_id")
    return events.where(F.col("event_type") != "signup").select(
        eid.alias("event_id"),
        F.lit("driver_update").alias("event_type"),
        F.concat(F.lit("driver_"), _id_str("user_id")).alias("driver_id"),
        F.col("ts").alias("event_ts"),
        F.when(eid % 97 == 0, F.lit(None).cast("double")).otherwise(
            _coord(40692800, 7919, 40001)).alias("lat"),
        F.when(eid % 97 == 0, F.lit(None).cast("double")).otherwise(
            -_coord(73986000, 104729, 40001)).alias("lon"),
        F.when(F.col("event_type").isin("click", "view"), F.lit("idle")).otherwise(
            F.lit("on_trip")).alias("status"),
        F.when(eid % 53 == 0, F.lit(None).cast("double")).otherwise(
            (F.lit(50) + (eid * 31) % 50).cast("double") / 100).alias("accept_rate_7d"),
        F.when(eid % 41 == 0, F.lit(None).cast("double")).otherwise(
            (F.lit(200) + (eid * 17) % 1301).cast("double")).alias("avg_response_ms"),
    )


def rider_requests(events: DataFrame) -> DataFrame:
    """fx_rider_requests: one ride request per signup event."""
    eid = F.col("event_id")
    return events.where(F.col("event_type") == "signup").select(
        eid.alias("event_id"),
        F.concat(F.lit("request_"), _id_str("event_id")).alias("request_id"),
        F.concat(F.lit("rider_"), _id_str("user_id")).alias("rider_id"),
        F.col("ts").alias("request_ts"),
        _coord(40662800, 6151, 100001).alias("rider_lat"),
        (-_coord(73956000, 3571, 100001)).alias("rider_lon"),
        F.when(eid % 2 == 0, F.lit("sedan")).otherwise(F.lit("suv")).alias("pref_vehicle"),
        F.when(eid % 11 == 0, F.lit(None).cast("int"))
        .when(eid % 37 == 0, F.lit(0))
        .otherwise(F.lit(1) + (eid % 7).cast("int")).alias("top_k"),
        (F.lit(5) + (eid % 6).cast("int")).alias("num_candidates"),
    )


def entities(events: DataFrame) -> DataFrame:
    """fx_entities: (row_id, driver_id, event_timestamp) rows wanting features."""
    eid = F.col("event_id")
    return events.where(F.col("event_type") == "signup").select(
        F.concat(F.lit("request_"), _id_str("event_id")).alias("row_id"),
        F.when(eid % 101 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("driver_"), _id_str("user_id"))).alias("driver_id"),
        F.col("ts").alias("event_timestamp"),
    )


def calls(events: DataFrame) -> DataFrame:
    """fx_calls: one served API call per event, latency in seconds."""
    eid = F.col("event_id")
    return events.select(
        eid.alias("event_id"), "ts", "user_id",
        (F.col("value") / 250).alias("latency_s"),
        F.when(F.col("event_type") == "error",
               F.when(eid % 3 == 0, F.lit("lookup_error")).otherwise(F.lit("inference_error"))
               ).alias("error_type"),
    )


def driver_events_json(events: DataFrame) -> DataFrame:
    """Driver updates rendered as raw topic lines (``value`` STRING).

    Every 29th line is not JSON, every 31st is empty and every 23rd carries
    an empty driver_id, so decoding and routing have something to reject.
    """
    d = driver_events(events)
    eid = F.col("event_id")
    ts_iso = F.concat(F.regexp_replace(F.col("event_ts").cast("string"), " ", "T"), F.lit("+00:00"))
    body = F.to_json(F.struct(
        F.col("event_type"),
        F.when(eid % 23 == 0, F.lit("")).otherwise(F.col("driver_id")).alias("driver_id"),
        F.col("lat"), F.col("lon"), F.col("status"),
        ts_iso.alias("timestamp"),
        F.col("accept_rate_7d"),
        F.col("avg_response_ms"),
        eid.alias("event_id"),
    ))
    value = (F.when(eid % 29 == 0, F.lit("not json"))
             .when(eid % 31 == 0, F.lit(""))
             .otherwise(body))
    return d.select(value.alias("value"))


def rider_requests_json(events: DataFrame) -> DataFrame:
    """Rider requests as raw topic lines with an ``origin`` [lat, lon] array."""
    r = rider_requests(events)
    ts_iso = F.concat(F.regexp_replace(F.col("request_ts").cast("string"), " ", "T"), F.lit("+00:00"))
    body = F.to_json(F.struct(
        F.lit("rider_request").alias("event_type"),
        F.col("request_id"), F.col("rider_id"),
        F.array(F.col("rider_lat"), F.col("rider_lon")).alias("origin"),
        F.array(F.col("rider_lat"), F.col("rider_lon")).alias("dest"),
        ts_iso.alias("timestamp"),
        F.col("pref_vehicle"),
        F.col("event_id"),
    ))
    return r.select(body.alias("value"))


def topic_lines(events: DataFrame) -> DataFrame:
    """Both record kinds interleaved, as one topic would carry them."""
    return driver_events_json(events).unionByName(rider_requests_json(events))


# Fixture views as SQL, for the DuckDB oracle (prepended as CTEs).
FIXTURE_SQL = {
    "fx_driver_events": """
SELECT event_id, 'driver_update' AS event_type,
  concat('driver_', CAST(user_id AS VARCHAR(20))) AS driver_id, ts AS event_ts,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(40692800 + (event_id * 7919) % 40001 AS DOUBLE) / 1000000 END AS lat,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE -CAST(73986000 + (event_id * 104729) % 40001 AS DOUBLE) / 1000000 END AS lon,
  CASE WHEN event_type IN ('click', 'view') THEN 'idle' ELSE 'on_trip' END AS status,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(50 + (event_id * 31) % 50 AS DOUBLE) / 100 END AS accept_rate_7d,
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(200 + (event_id * 17) % 1301 AS DOUBLE) END AS avg_response_ms
FROM events WHERE event_type <> 'signup'""",
    "fx_rider_requests": """
SELECT event_id, concat('request_', CAST(event_id AS VARCHAR(20))) AS request_id,
  concat('rider_', CAST(user_id AS VARCHAR(20))) AS rider_id, ts AS request_ts,
  CAST(40662800 + (event_id * 6151) % 100001 AS DOUBLE) / 1000000 AS rider_lat,
  -CAST(73956000 + (event_id * 3571) % 100001 AS DOUBLE) / 1000000 AS rider_lon,
  CASE WHEN event_id % 2 = 0 THEN 'sedan' ELSE 'suv' END AS pref_vehicle,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 37 = 0 THEN 0 ELSE 1 + CAST(event_id % 7 AS INT) END AS top_k,
  5 + CAST(event_id % 6 AS INT) AS num_candidates
FROM events WHERE event_type = 'signup'""",
    "fx_entities": """
SELECT concat('request_', CAST(event_id AS VARCHAR(20))) AS row_id,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE concat('driver_', CAST(user_id AS VARCHAR(20))) END AS driver_id,
  ts AS event_timestamp
FROM events WHERE event_type = 'signup'""",
    "fx_calls": """
SELECT event_id, ts, user_id, value / 250 AS latency_s,
  CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 3 = 0 THEN 'lookup_error' ELSE 'inference_error' END END AS error_type
FROM events""",
}


def with_fixtures(sql: str, *extra_ctes: tuple[str, str]) -> str:
    """Prefix an oracle query with the fixture views (and extra CTEs) it needs."""
    ctes = [(k, v) for k, v in FIXTURE_SQL.items()] + list(extra_ctes)
    used = [(k, v) for k, v in ctes if k in sql or any(k in v2 for _, v2 in extra_ctes)]
    body = ",\n".join(f"{k} AS ({v.strip()})" for k, v in used)
    return f"WITH {body}\n{sql.strip()}"
