"""Feature drift over count windows.

Per feature: every ``step`` observations, the p95 of the last ``window``
observations (fewer at the start) is compared with the baseline p95:
``|cur - base| / base``, or ``|cur - base|`` when the baseline is 0.

Plan: observations are numbered per feature by a distributed sort
(``with_group_index``, no one-task window) and gathered in stretches of
``SPAN`` checkpoints, with the ``window - 1`` observations before them, so that
one in ten is copied, once.  A stretch is one array in order of the numbers,
of bounded length; the exact percentile of each of its windows is read from a
sorted slice of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetcast.functions.frames import with_group_index

# Alert thresholds of the reference's dashboard.
SPAN = 100         # checkpoints a stretch
YELLOW = 0.1
RED = 0.2


def observations(df: DataFrame, features, order_cols) -> DataFrame:
    """Long form (feature_name, value, *order) without nulls or NaNs."""
    long_df = df.select(*order_cols, *features).unpivot(list(order_cols), list(features), "feature_name", "value")
    return long_df.where(F.col("value").isNotNull() & ~F.isnan("value"))


def drift_score(obs: DataFrame, baseline: DataFrame, order_cols, window: int = 1000, step: int = 100,
                quantile: float = 0.95) -> DataFrame:
    """One row per (feature_name, checkpoint) with current p95 and drift.

    ``obs``: feature_name, value, *order_cols.  ``baseline``: feature_name, p95.
    Features absent from the baseline are ignored.
    """
    obs = obs.join(F.broadcast(baseline.select("feature_name")), "feature_name", "left_semi")  # few features
    numbered = with_group_index(obs, list(order_cols), ["feature_name"], "_i") \
        .select("feature_name", "value", (F.col("_i") + 1).alias("_n"))
    bounds = obs.groupBy("feature_name").agg(F.lit(0).cast("long").alias("_lo"),
                                             F.count(F.lit(1)).alias("_hi"))
    return drift_checkpoints(numbered, bounds, baseline, window, step, quantile)


def drift_checkpoints(numbered: DataFrame, bounds: DataFrame, baseline: DataFrame, window: int = 1000,
                      step: int = 100, quantile: float = 0.95) -> DataFrame:
    """Checkpoints ``c`` (multiples of ``step``) with ``_lo < c <= _hi`` per feature.

    ``numbered``: feature_name, value, ``_n`` (global 1-based position); it must
    hold every observation in ``(c - window, c]`` of each such checkpoint.
    ``bounds``: feature_name, ``_lo``, ``_hi`` (one row per feature).
    """
    base = baseline.select("feature_name", F.col("p95").alias("baseline_p95"))
    n, wide = F.col("_n"), F.lit(SPAN * step)
    # Stretch s has the checkpoints in (s * wide, (s + 1) * wide]; rows shortly before it belong to it too.
    first = F.greatest(F.floor((n - 1) / wide), F.floor((F.floor(F.col("_lo") / F.lit(step)) * step) / wide))
    last = F.least(F.floor((n + F.lit(window - 2)) / wide), F.floor((F.floor(F.col("_hi") / F.lit(step)) * step - 1) / wide))
    spread = (numbered.join(F.broadcast(bounds), "feature_name")
              .where(first <= last)
              .withColumn("_s", F.explode(F.sequence(first.cast("long"), last.cast("long")))))
    # As 16 bytes a row: what a task holds while it gathers stays small.
    packed = F.struct(n.alias("n"), F.col("value").alias("v"))
    rows = spread.groupBy("feature_name", "_s").agg(
        F.array_sort(F.collect_list(packed)).alias("_rows"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    low = F.greatest(F.col("_s") * SPAN, F.floor(F.col("_lo") / F.lit(step))) + 1
    high = F.least((F.col("_s") + 1) * SPAN, F.floor(F.col("_hi") / F.lit(step)))
    cut = rows.where(low <= high).select(
        "feature_name", F.transform("_rows", lambda r: r["v"]).alias("_v"), F.col("_rows")[0]["n"].alias("_from"),
        F.explode(F.sequence(low.cast("long"), high.cast("long"))).alias("checkpoint"))
    end = F.col("checkpoint") * step
    start = F.greatest(end - F.lit(window), F.lit(0).cast("long")) + 1
    cur = cut.select("feature_name", "checkpoint", (end - start + 1).alias("window_size"), F.sort_array(
        F.slice("_v", (start - F.col("_from") + 1).cast("int"), (end - start + 1).cast("int"))).alias("_w"))
    # Linear interpolation, in the form of Spark's percentile.
    at = (F.col("window_size") - 1) * F.lit(float(quantile))
    below, above = F.get("_w", F.floor(at).cast("int")), F.get("_w", F.ceil(at).cast("int"))
    cur = cur.withColumn("current_p95", F.when(below == above, below).otherwise(
        (F.ceil(at) - at) * below + (at - F.floor(at)) * above))
    b = F.col("baseline_p95")
    drift = F.when(b == 0, F.abs(F.col("current_p95") - b)).otherwise(F.abs(F.col("current_p95") - b) / b)
    return (cur.join(F.broadcast(base), "feature_name")
            .select("feature_name", (F.col("checkpoint") * step).alias("observations"), "window_size",
                    "current_p95", "baseline_p95", drift.alias("drift")))


def drift_status(df: DataFrame, col: str = "drift") -> DataFrame:
    """Green < 0.1 <= yellow < 0.2 <= red."""
    d = F.col(col)
    return df.withColumn("status", F.when(d < YELLOW, F.lit("green")).when(d < RED, F.lit("yellow"))
                         .otherwise(F.lit("red")))
