"""Topic sources, decoding, routing and the offline event table.

Decoding is row-local (``from_json``), so it runs inside the scan's tasks
with no shuffle; only the audit is an aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetcast.functions.geo import unpack_point
from fleetcast.schemas import DRIVER_EVENT_COLUMNS, EVENT_SCHEMA, OFFLINE_DRIVER_SCHEMA

CORRUPT = "_corrupt"


# ------------------------------------------------------------------ sources

def read_events_stream(spark: SparkSession, *, kafka_servers: str | None = None, topic: str | None = None,
                       path: str | None = None, max_per_trigger: int | None = None) -> DataFrame:
    """The event topic as a stream of ``value`` strings.

    With ``kafka_servers`` + ``topic`` this is the Kafka source from the
    earliest offset (needs the Kafka connector on the classpath).  With
    ``path`` it is a directory of text files, one message per line — the form
    used in tests.  ``max_per_trigger`` bounds each micro-batch.
    """
    if kafka_servers:
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", kafka_servers)
             .option("subscribe", topic)
             .option("startingOffsets", "earliest"))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        return r.load().select(F.col("value").cast("string").alias("value"))
    r = spark.readStream.format("text")
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    return r.load(path)


def read_events_batch(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of the same text layout (replays, backfills)."""
    return spark.read.text(path)


# ------------------------------------------------------------------ decoding

def parse_event_time(col) -> Column:
    """ISO-8601 text (``Z``, ``+00:00``, fractions) → UTC wall clock (TIMESTAMP_NTZ).

    Malformed text gives null instead of failing the batch.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c).cast("timestamp_ntz")


def decode_events(lines: DataFrame, value_col: str = "value", on_bad: str = "reject") -> DataFrame:
    """JSON lines → typed records with ``event_ts`` and an ``_error`` reason.

    Empty lines are kept with ``_error = "empty"`` so one aggregate can audit
    the batch; routes and ``rejects`` skip them.  ``on_bad="reject"`` keeps bad
    lines with ``_error`` set; ``on_bad="fail"`` raises on the first one (FAILFAST).
    """
    v = F.col(value_col)
    empty = v.isNull() | (F.length(F.trim(v)) == 0)
    extra = [c for c in lines.columns if c != value_col]
    if on_bad == "fail":
        nonempty = lines.where(~empty)
        out = nonempty.select(*extra, F.inline(F.array(F.from_json(v, EVENT_SCHEMA, {"mode": "FAILFAST"})))) \
            .withColumn("_error", F.lit(None).cast("string"))
    else:
        schema = T.StructType(EVENT_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
        parsed_struct = F.when(~empty, F.from_json(v, schema, {
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
        # ``inline`` (a Generate) yields the parsed fields as columns once per
        # line.  Filters on them cannot be pushed below it, so the optimizer
        # does not re-parse the JSON for every predicate that reads a field.
        out = lines.select(*extra, v.alias("_raw"), empty.alias("_empty"),
                           F.inline(F.array(parsed_struct))).withColumn(
            "_error", F.when(F.col("_empty"), F.lit("empty"))
            .when(F.col(CORRUPT).isNotNull(), F.lit("malformed_json")))
        out = out.drop(CORRUPT, "_empty")
    ts = parse_event_time("timestamp")
    out = out.withColumn("event_ts", ts).withColumn(
        "_error", F.coalesce(F.col("_error"), F.when(ts.isNull(), F.lit("bad_timestamp"))))
    if on_bad == "fail":
        out = out.withColumn("event_ts", F.when(ts.isNull(), F.raise_error(
            F.concat(F.lit("unparseable timestamp: "), F.coalesce(F.col("timestamp"), F.lit("null"))))
        ).otherwise(ts))
    return out


def is_driver_event(col: str = "driver_id") -> Column:
    """Rows with a non-null, non-empty driver key."""
    return F.col(col).isNotNull() & (F.length(F.col(col)) > 0)


def route_driver_events(decoded: DataFrame) -> DataFrame:
    """Well-formed driver updates, in the offline table's column order."""
    ok = decoded.where(F.col("_error").isNull() & is_driver_event())
    return ok.select(*DRIVER_EVENT_COLUMNS)


def route_rider_requests(decoded: DataFrame) -> DataFrame:
    """Well-formed rider requests, origin/dest arrays unpacked."""
    ok = decoded.where(F.col("_error").isNull() & ~is_driver_event()
                       & (F.col("event_type") == "rider_request"))
    return ok.select("event_id", "event_type", "request_id", "rider_id", "event_ts",
                     *unpack_point("origin", "rider_lat", "rider_lon"),
                     *unpack_point("dest", "dest_lat", "dest_lon"), "pref_vehicle")


def rejects(decoded: DataFrame) -> DataFrame:
    """Everything neither route keeps, with the reason."""
    reason = F.coalesce(F.col("_error"), F.lit("unroutable"))
    bad = decoded.where(F.coalesce(F.col("_error") != "empty", F.lit(True)) & (
        F.col("_error").isNotNull() | (~is_driver_event() & (
            F.col("event_type").isNull() | (F.col("event_type") != "rider_request")))))
    cols = ["_raw"] if "_raw" in decoded.columns else []
    return bad.select(*cols, "event_type", "event_id", reason.alias("reason"))


def ingest_audit(decoded: DataFrame, batch_col: str | None = None) -> DataFrame:
    """Consumed / empty / kept / skipped counts per batch in one aggregate."""
    keys = [batch_col] if batch_col else []
    err = F.col("_error")
    drv = err.isNull() & is_driver_event()
    rid = err.isNull() & ~is_driver_event() & (F.col("event_type") == "rider_request")
    return decoded.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(err == "empty").alias("empty"),
        F.count_if(drv).alias("driver_rows"),
        F.count_if(rid).alias("rider_rows"),
        F.count_if(err == "malformed_json").alias("malformed"),
        F.count_if(err == "bad_timestamp").alias("bad_timestamp"),
        F.count_if(err.isNull() & ~drv & ~rid).alias("unroutable"))


def extract_partition_cols(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Unpadded year / month / day partition values."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


# ------------------------------------------------------------------ sinks

def write_driver_events(df: DataFrame, path: str, partition_on: str = "event_ts",
                        mode: str = "append", table: str | None = None) -> None:
    """Append Parquet below ``year=/month=/day=``.

    ``partition_on="event_ts"`` partitions by event time (so time filters
    prune directories); ``"ingest_ts"`` by the wall clock of the write.  The
    table (``path``, or the ``table`` that its files will be moved to) remembers
    its clock; rows are clustered by date first, so each task writes to few folders.
    """
    mark_clock(df.sparkSession, table or path, partition_on)
    if partition_on == "ingest_ts":
        df = df.withColumn("_ingest_ts", F.current_timestamp().cast("timestamp_ntz"))
        df = extract_partition_cols(df, "_ingest_ts").drop("_ingest_ts")
    else:
        df = extract_partition_cols(df, partition_on)
    df.repartition("year", "month", "day", F.pmod(F.xxhash64(*df.columns), F.lit(DATE_FILES))) \
        .write.mode(mode).partitionBy("year", "month", "day").parquet(path)


#: Tasks that share the rows of one date, so that no date lands in one task.
DATE_FILES = 8


def _clocks(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_clock")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def mark_clock(spark: SparkSession, path: str, clock: str) -> None:
    """Note in the table (an empty file below ``_clock``) which time its date folders hold."""
    fs, folder = _clocks(spark, path)
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(folder, clock), True).close()


def folders_hold(spark: SparkSession, path: str, clock: str) -> bool:
    """Whether all date folders of the table are known to hold ``clock``."""
    fs, folder = _clocks(spark, path)
    return fs.exists(folder) and [st.getPath().getName() for st in fs.listStatus(folder)] == [clock]


def read_offline_events(spark: SparkSession, path: str, columns=None, start=None, end=None,
                        ts: str = "event_ts") -> DataFrame:
    """Scan the offline table with a fixed schema; prune columns and partitions.

    A time range becomes an ``event_ts`` predicate (pushed to Parquet) and, where
    the ``year/month/day`` directories hold that time, one on them as well
    (partition pruning).
    """
    schema = T.StructType(OFFLINE_DRIVER_SCHEMA.fields + [
        T.StructField(c, T.IntegerType()) for c in ("year", "month", "day")])
    df = spark.read.schema(schema).parquet(path)
    if start is not None or end is not None:
        prune = folders_hold(spark, path, ts)
        day = F.make_date("year", "month", "day")
        if start is not None:
            df = df.where(F.col(ts) >= F.lit(start))
            df = df.where(day >= F.to_date(F.lit(start))) if prune else df
        if end is not None:
            df = df.where(F.col(ts) <= F.lit(end))
            df = df.where(day <= F.to_date(F.lit(end))) if prune else df
    return df.select(*(columns or [f.name for f in OFFLINE_DRIVER_SCHEMA.fields]))


def feature_source(spark: SparkSession, source, columns=None, start=None, end=None) -> DataFrame:
    """A view's source spec → its offline rows."""
    return read_offline_events(spark, source.path, columns, start, end, source.timestamp_field)
