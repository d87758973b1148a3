"""Data quality and baseline statistics (A6-A9, A11, exact quantiles).

Quantiles are exact and linearly interpolated (numpy's default).  Equal values
are counted first (aggregated before any shuffle, so a value on most rows is one
row); what else is asked of a column follows from these counts, so the input is
read once.  Order statistics are found without a sort: the interval that holds a
rank is cut into buckets, the buckets are counted, and the one with the rank is
the next interval, until it holds one value.  ``percentile`` is not used: its
buffer grows with distinct values.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SELECT_ROWS = 1 << 14   # buckets that a pass of the selection brings back


def to_long(df: DataFrame, cols, name: str = "feature", value: str = "value",
            keep=()) -> DataFrame:
    """Unpivot ``cols`` into (name, value) rows, keeping ``keep`` columns."""
    return df.unpivot(list(keep), list(cols), name, value) if keep else \
        df.select(*cols).unpivot([], list(cols), name, value)


def value_counts(long_df: DataFrame, group: str = "feature", value: str = "value") -> DataFrame:
    """Rows per group and value (``_c``), nulls and NaNs left out."""
    clean = long_df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    return clean.groupBy(group, F.col(value).cast("double").alias(value)).agg(F.count(F.lit(1)).alias("_c"))


def _totals(counts: DataFrame, group: str, value: str) -> dict:
    v, c = F.col(value), F.col("_c")
    return {r[group]: r.asDict() for r in counts.groupBy(group).agg(
        F.sum(c).alias("count"), (F.sum(v * c) / F.sum(c)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))
        .collect()}   # one row a column


def order_statistics(counts: DataFrame, wanted: dict, totals: dict, group: str = "feature",
                     value: str = "value") -> dict:
    """(group, rank) -> value, for 0-based ranks ``wanted[group]``; ``counts`` as ``value_counts`` gives them.

    Each pass brings back at most ``SELECT_ROWS`` buckets.  Buckets are even, in
    the first pass on a logarithmic scale, so a few passes do at any spread.
    """
    spark, found = counts.sparkSession, {}
    # An interval: smallest and greatest value, and how many rows lie before it.
    open_ranks = {(g, r): (totals[g]["min"], totals[g]["max"], 0) for g in wanted for r in wanted[g]}
    first = True
    while open_ranks:
        spans = sorted({(g, lo, hi) for (g, _), (lo, hi, _) in open_ranks.items() if lo < hi}, key=str)
        seen: dict = {span: [] for span in spans}
        if spans:
            each = max(4, SELECT_ROWS // len(spans))
            table = F.broadcast(spark.createDataFrame(
                [(g, float(lo), float(hi), n) for n, (g, lo, hi) in enumerate(spans)],
                f"{group} string, _lo double, _hi double, _span int"))   # at most one row a rank
            v, lo, hi = F.col(value), F.col("_lo"), F.col("_hi")

            def scale(c):
                return F.signum(c) * F.log1p(F.abs(c)) if first else c
            width = scale(hi) - scale(lo)
            inner = F.when(width > 0, F.least(F.floor((scale(v) - scale(lo)) / width * (each - 2)), F.lit(each - 3)))
            # Both ends have buckets of their own, so every pass gets on, infinite ends included.
            part = F.when(v <= lo, 0).when(v >= hi, each - 1).otherwise(1 + F.coalesce(inner, F.lit(0)))
            rows = counts.join(table, group).where((v >= lo) & (v <= hi)).withColumn("_part", part.cast("int"))
            for r in rows.groupBy("_span", "_part").agg(F.sum("_c").alias("n"), F.min(v).alias("lo"),
                                                        F.max(v).alias("hi")).collect():
                seen[spans[r["_span"]]].append((r["lo"], r["hi"], r["n"]))
        nxt = {}
        for (g, rank), (lo, hi, before) in open_ranks.items():
            if lo == hi:
                found[g, rank] = lo
                continue
            for a, b, n in sorted(seen[g, lo, hi]):
                if before + n > rank:
                    nxt[g, rank] = (a, b, before)
                    break
                before += n
        open_ranks, first = nxt, False
    return found


def exact_quantiles(long_df: DataFrame, qs: dict[str, float], group: str = "feature",
                    value: str = "value") -> DataFrame:
    """Per group (a column: few of them), linear-interpolated quantiles over non-null, non-NaN values."""
    counts = value_counts(long_df, group, value).persist()
    try:
        rows = _quantile_rows(counts, qs, _totals(counts, group, value), group, value)
    finally:
        counts.unpersist()
    return long_df.sparkSession.createDataFrame(
        [(g, *(row[q] for q in qs)) for g, row in rows.items()], ", ".join([f"{group} string", *(f"{q} double" for q in qs)]))


def _quantile_rows(counts: DataFrame, qs: dict[str, float], totals: dict, group: str, value: str) -> dict:
    place = {(g, q): qs[q] * (t["count"] - 1) for g, t in totals.items() for q in qs}
    wanted = {g: {r for q in qs for r in (math.floor(place[g, q]), math.ceil(place[g, q]))} for g in totals}
    at = order_statistics(counts, wanted, totals, group, value)
    out: dict = {g: {} for g in totals}
    for (g, q), p in place.items():
        lo, hi = at[g, math.floor(p)], at[g, math.ceil(p)]
        out[g][q] = lo + (hi - lo) * (p - math.floor(p))
    return out


def feature_baseline(df: DataFrame, cols) -> DataFrame:
    """Count, mean, sample std, p50, p95, min, max per feature (nulls skipped), with one read of ``df``."""
    counts = value_counts(to_long(df, cols)).persist()
    try:
        totals = _totals(counts, "feature", "value")
        quantiles = _quantile_rows(counts, {"p50": 0.5, "p95": 0.95}, totals, "feature", "value")
        mean = F.create_map(*[F.lit(x) for g, t in totals.items() for x in (g, t["mean"])]) if totals else None
        off = F.col("value") - mean[F.col("feature")] if totals else None
        squares = {r["feature"]: r["s"] for r in counts.groupBy("feature").agg(
            F.sum(off * off * F.col("_c")).alias("s")).collect()} if totals else {}
    finally:
        counts.unpersist()
    rows = [(g, t["count"], t["mean"], math.sqrt(squares[g] / (t["count"] - 1)) if t["count"] > 1 else None,
             quantiles[g]["p50"], quantiles[g]["p95"], t["min"], t["max"]) for g, t in totals.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, count bigint, mean double, std double, p50 double, "
                                                 "p95 double, min double, max double")


def missing_counts(df: DataFrame, cols, name: str = "feature_name") -> DataFrame:
    """Nulls per feature column, one aggregate pass, long form."""
    row = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c)) if dict(df.dtypes)[c] == "double"
                              else F.col(c).isNull()).alias(c) for c in cols])
    return row.unpivot([], list(cols), name, "missing")


def non_null_counts(df: DataFrame, cols=None) -> DataFrame:
    """Non-null count per column, long form; NaN counts as null."""
    cols = list(cols or df.columns)
    kinds = dict(df.dtypes)
    row = df.agg(*[F.count(F.when(~F.isnan(c), F.col(c)) if kinds[c] in ("double", "float") else F.col(c)).alias(c)
                   for c in cols])
    return row.unpivot([], cols, "column_name", "non_null")


def all_null_guard(df: DataFrame, required=("lat", "lon")) -> None:
    """Fail when every required column is null in every row."""
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in required]).first()
    if all(row[c] == 0 for c in required):
        raise RuntimeError(f"point-in-time join returned only nulls for {list(required)}; "
                           "entity timestamps probably do not line up with feature rows")


def label_balance(df: DataFrame, label: str = "label", group: str = "request_id") -> DataFrame:
    """Positives, positive share, examples and distinct requests."""
    return df.agg(F.sum(label).cast("long").alias("positives"),
                  F.avg(label).alias("positive_share"),
                  F.count(F.lit(1)).alias("examples"),
                  F.countDistinct(group).alias("requests"))
