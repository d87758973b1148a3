"""Monitoring aggregates.

A histogram is one aggregate per label set with a conditional count for each
bound (map-side partial, one exchange), turned into bucket rows afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetcast.functions.segments import in_ranges, previous, scan

# Histogram bucket upper bounds of the reference's metrics (+Inf implied).
LATENCY_BOUNDS = (0.01, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0)
SCORE_BOUNDS = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)
FEATURE_BOUNDS = (0.0, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0)

INF = float("inf")


def bucket_le(value: Column, bounds) -> Column:
    """Smallest bound ``le`` with ``value <= le``; +Inf beyond the last."""
    expr = F.lit(INF)
    for b in reversed(bounds):
        expr = F.when(value <= F.lit(float(b)), F.lit(float(b))).otherwise(expr)
    return F.when(value.isNotNull(), expr)


def bucket_histogram(df: DataFrame, value: str, bounds, labels=(), extra_keys=()) -> DataFrame:
    """Cumulative bucket counts plus sum and count, per label set.

    Output: *labels, *extra_keys, le, bucket_count (cumulative), sum, count.
    Every bound appears, empty buckets included.
    """
    keys = [*labels, *extra_keys]
    v = F.col(value)
    per = df.where(v.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"), F.sum(v).alias("sum"),
        *[F.count_if(v <= F.lit(float(b))).alias(f"_b{i}") for i, b in enumerate(bounds)])
    buckets = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("bucket_count"))
                        for i, b in enumerate(bounds)],
                      F.struct(F.lit(INF).alias("le"), F.col("count").alias("bucket_count")))
    return per.where(F.col("count") > 0).select(*keys, F.inline(buckets), "sum", "count") \
        .select(*keys, "le", "bucket_count", "sum", "count")


def labelled_counter(df: DataFrame, label: str, value: str | None = None, name: str = "total") -> DataFrame:
    """Count (or sum of ``value``) per label value; null labels are not counted."""
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(agg.alias(name))


def rate_per_window(df: DataFrame, ts: str, width: str = "1 minute", labels=(), value: str | None = None,
                    name: str = "rate") -> DataFrame:
    """Per tumbling window, count (or sum) divided by the window length in seconds."""
    seconds = _seconds(width)
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    out = df.groupBy(F.window(ts, width).alias("_w"), *labels).agg((agg / F.lit(float(seconds))).alias(name))
    return out.select(F.col("_w.start").cast("timestamp_ntz").alias("window_start"), *labels, name)


def bucket_rates(df: DataFrame, value: str, bounds, ts: str, width: str, slide: str | None = None,
                 labels=()) -> DataFrame:
    """A12 + A16 per (sliding) window: cumulative ``le`` counts, and observations a second up to each bound.

    Batch and stream alike: one windowed aggregate with a conditional count for
    each bound, turned into rows afterwards.  Every bound of a window with an
    observation appears.
    """
    v = F.col(value)
    per = df.where(v.isNotNull()).groupBy(F.window(ts, width, slide).alias("_w"), *labels).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(v <= F.lit(float(b))).alias(f"_b{i}") for i, b in enumerate(bounds)])
    buckets = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("bucket_count"))
                        for i, b in enumerate(bounds)], F.struct(F.lit(INF).alias("le"), F.col("_n").alias("bucket_count")))
    return per.select(F.col("_w.start").cast("timestamp_ntz").alias("window_start"), *labels, F.inline(buckets)) \
        .withColumn("rate", F.col("bucket_count") / F.lit(float(_seconds(width))))


def counter_rates(samples: DataFrame, value: str, ts: str, width: str, slide: str | None = None, labels=(),
                  tiebreak=()) -> DataFrame:
    """A16 from sampled counters: increase and rate of each series over trailing windows.

    A counter only grows; a sample below the one before it in its series means
    that the process began anew from 0, so the whole value is increase.  A window
    counts the steps between samples that both lie in it, over the time from its
    first to its last sample; with fewer than two samples, or all at one time, the
    rate is null.  Samples without time or value are left out.  Samples are put in
    order by a segmented scan, so a series with most of them is no single task.
    """
    labels, order = list(labels), [ts, *tiebreak, "_any"]
    if not labels:
        raise ValueError("a series needs labels")
    known = samples.where(F.col(ts).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    for label in labels:
        known = known.where(F.col(label).isNotNull())
    known = known.withColumn("_any", F.xxhash64(*known.columns))
    last = F.col("_before._value")
    ranged = in_ranges(known.withColumn("_value", F.col(value).cast("double")), labels, order)
    steps = scan(ranged, labels, order, _before=previous("_value")).withColumn(
        "_step", F.when(F.col("_value") >= last, F.col("_value") - last).otherwise(F.col("_value")))
    at = F.struct(*order)
    per = steps.groupBy(F.window(ts, width, slide).alias("_w"), *labels).agg(
        F.count(F.lit(1)).alias("samples"), F.sum("_step").alias("_sum"), F.min_by("_step", at).alias("_first"),
        F.min(F.unix_micros(F.col(ts).cast("timestamp"))).alias("_t0"),
        F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("_t1"))
    increase = F.col("_sum") - F.coalesce("_first", F.lit(0.0))
    seconds = (F.col("_t1") - F.col("_t0")) / F.lit(1e6)
    return per.select(F.col("_w.start").cast("timestamp_ntz").alias("window_start"), *labels, "samples",
                      increase.alias("increase"), F.when(seconds > 0, increase / seconds).alias("rate"))


def sum_by_le(hist: DataFrame, keys=("window_start",), value: str = "bucket_count") -> DataFrame:
    """Add bucket series over all other labels."""
    return hist.groupBy(*keys, "le").agg(F.sum(value).alias(value))


def histogram_quantile(hist: DataFrame, q: float, keys=(), le: str = "le",
                       cum: str = "bucket_count") -> DataFrame:
    """Quantile estimate from cumulative buckets (linear inside the bucket).

    The bucket holding rank ``q * total`` is found with a window over the
    small bucket table; below the first bound the lower edge is 0; a rank in
    the +Inf bucket returns the highest finite bound.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(le) if keys else Window.orderBy(le)
    wall = Window.partitionBy(*keys) if keys else Window.partitionBy()
    h = (hist.select(*keys, le, cum)
         .withColumn("_total", F.max(cum).over(wall))
         .withColumn("_prev_le", F.lag(le).over(w))
         .withColumn("_prev_cum", F.coalesce(F.lag(cum).over(w), F.lit(0)))
         .withColumn("_max_finite", F.max(F.when(F.col(le) != F.lit(INF), F.col(le))).over(wall)))
    rank = F.lit(q) * F.col("_total")
    hit = h.where((F.col(cum) >= rank) & (F.col("_total") > 0))
    first = Window.partitionBy(*keys).orderBy(le) if keys else Window.orderBy(le)
    hit = hit.withColumn("_r", F.row_number().over(first)).where(F.col("_r") == 1)
    lower = F.when(F.col("_prev_le").isNull(), F.least(F.lit(0.0), F.col(le))).otherwise(F.col("_prev_le"))
    inside = F.col(cum) - F.col("_prev_cum")
    est = F.when(F.col(le) == F.lit(INF), F.col("_max_finite")).otherwise(
        lower + (F.col(le) - lower) * F.when(inside > 0, (rank - F.col("_prev_cum")) / inside).otherwise(F.lit(1.0)))
    return hit.select(*keys, est.alias("quantile"))


def _seconds(width: str) -> int:
    n, unit = width.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit]
    return int(n) * mult
