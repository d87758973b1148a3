"""Record schemas (fixed, never inferred per batch)."""

from __future__ import annotations

from pyspark.sql import types as T

# One union schema for both record kinds on the topic; `_corrupt` receives
# lines that are not JSON (PERMISSIVE parsing).
EVENT_SCHEMA = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("driver_id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("accept_rate_7d", T.DoubleType()),
    T.StructField("avg_response_ms", T.DoubleType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("rider_id", T.StringType()),
    T.StructField("origin", T.ArrayType(T.DoubleType())),
    T.StructField("dest", T.ArrayType(T.DoubleType())),
    T.StructField("pref_vehicle", T.StringType()),
    T.StructField("event_id", T.LongType()),
])

DRIVER_EVENT_COLUMNS = ["event_id", "event_type", "driver_id", "event_ts", "lat", "lon", "status",
                        "accept_rate_7d", "avg_response_ms"]

RIDER_REQUEST_COLUMNS = ["event_id", "event_type", "request_id", "rider_id", "event_ts",
                         "rider_lat", "rider_lon", "dest_lat", "dest_lon", "pref_vehicle"]

OFFLINE_DRIVER_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("driver_id", T.StringType()),
    T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("accept_rate_7d", T.DoubleType()),
    T.StructField("avg_response_ms", T.DoubleType()),
])

MATCH_ITEM = T.StructType([
    T.StructField("driver_id", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("distance_km", T.DoubleType()),
])
