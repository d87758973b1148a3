"""Latest-value snapshots, expiry and online lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys=("driver_id",), ts: str = "event_ts",
                   tiebreak=("event_id",)) -> DataFrame:
    """Newest row per key, as one grouped ``max_by`` (map-side partial aggregation).

    Ties on ``ts`` are broken by ``tiebreak`` (descending: the larger wins);
    with no tiebreak every other column takes part in the order.  Rows with a
    null key or time are dropped: they can never be looked up.
    """
    keys = list(keys)
    vals = [c for c in df.columns if c not in keys]
    tb = list(tiebreak) if tiebreak else [c for c in vals if c != ts]
    order = F.struct(F.col(ts), *[F.col(c) for c in tb])
    cond = F.col(ts).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    agg = df.where(cond).groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in vals]), order).alias("_latest"))
    return agg.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in vals])


def time_bounds(col: str, start=None, end=None) -> Column:
    """``start <= col <= end`` (both inclusive); a missing bound is open."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(col) >= F.lit(start))
    if end is not None:
        cond = cond & (F.col(col) <= F.lit(end))
    return cond


def materialize(events: DataFrame, view, start=None, end=None, tiebreak=("event_id",),
                keep_tiebreak: bool = False) -> DataFrame:
    """Latest row per entity of one view inside ``[start, end]`` (A2).

    Output: keys, the view's fields (cast to the declared types) and ``event_ts``;
    with ``keep_tiebreak`` also the tiebreak columns, which a snapshot needs so
    that later merges decide between events of one instant as one batch would.
    """
    ts = view.source.timestamp_field
    cols = [*view.entity_keys, ts, *[c for c in tiebreak if c in events.columns], *view.field_names]
    src = events.where(time_bounds(ts, start, end)).select(*dict.fromkeys(cols))
    ties = tuple(c for c in tiebreak if c in events.columns)
    snap = latest_per_key(src, view.entity_keys, ts, ties)
    return snap.select(*view.entity_keys, *view.typed_fields(), F.col(ts).alias("event_ts"),
                       *(ties if keep_tiebreak else ()))


def materialize_incremental(events: DataFrame, previous: DataFrame | None, view,
                            high_water, end, tiebreak=("event_id",)) -> DataFrame:
    """Rows in ``(high_water, end]`` merged newest-wins into ``previous`` (A3)."""
    ts = view.source.timestamp_field
    fresh = events.where(F.col(ts) > F.lit(high_water)) if high_water is not None else events
    new = materialize(fresh, view, None, end, tiebreak, keep_tiebreak=True)
    if previous is None:
        return new
    return merge_newest(previous, new, view.entity_keys)


def merge_newest(old: DataFrame, new: DataFrame, keys, ts: str = "event_ts", tiebreak=("event_id",)) -> DataFrame:
    """Upsert where the newer event time wins; an older late row never overwrites.

    Rows of one instant go by the ``tiebreak`` columns that both sides have kept.
    """
    ties = tuple(c for c in tiebreak if c in old.columns and c in new.columns)
    both = old.select(*[c for c in old.columns if c in new.columns]).unionByName(
        new.select(*[c for c in old.columns if c in new.columns]))
    return latest_per_key(both, keys, ts, tiebreak=ties)


def expire(snapshot: DataFrame, as_of, ttl: dt.timedelta | None, fields, ts: str = "event_ts") -> DataFrame:
    """Null the fields of rows older than ``ttl`` at ``as_of`` (A4); rows stay."""
    if ttl is None:
        return snapshot
    fresh = F.col(ts) >= (F.lit(as_of) - F.expr(f"INTERVAL {int(ttl.total_seconds())} SECONDS"))
    return snapshot.withColumns({f: F.when(fresh, F.col(f)) for f in fields})


def online_lookup(keys: DataFrame, snapshots: list[tuple[DataFrame, list[str]]], key_cols,
                  as_of=None, ttls: list | None = None) -> DataFrame:
    """Left-join requested keys to each view snapshot; absent/expired → null.

    Every input key row is returned once.  The snapshots hold one row per
    entity; the planner (AQE) turns the join into a broadcast when the
    snapshot's runtime size is below the broadcast threshold.
    """
    key_cols = list(key_cols)
    out = keys
    for i, (snap, fields) in enumerate(snapshots):
        side = snap.select(*key_cols, *fields, F.col("event_ts").alias(f"_ts{i}"))
        if as_of is not None and ttls and ttls[i] is not None:
            side = expire(side, as_of, ttls[i], fields, ts=f"_ts{i}")
        out = out.join(side, key_cols, "left").drop(f"_ts{i}")
    return out


def online_coverage(df: DataFrame, keys, fields) -> DataFrame:
    """Per key: does any feature value exist (A10); NaN is none."""
    kinds = dict(df.dtypes)
    has = F.coalesce(*[(F.when(~F.isnan(f), F.col(f)) if kinds[f] in ("double", "float") else F.col(f)).cast("string")
                       for f in fields]).isNotNull()
    return df.select(*keys, has.alias("has_features"))
