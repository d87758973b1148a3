"""Feature definitions as plain Python values."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SourceSpec:
    """A Parquet location plus the column holding event time."""

    path: str | None = None
    timestamp_field: str = "event_ts"


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple[str, ...]


@dataclass(frozen=True)
class FeatureView:
    """Named, typed group of fields of one source, keyed by entities, with a TTL."""

    name: str
    entities: tuple[Entity, ...]
    fields: tuple[tuple[str, str], ...]  # (name, spark SQL type)
    source: SourceSpec
    ttl: dt.timedelta | None = None
    online: bool = True

    @property
    def entity_keys(self) -> list[str]:
        return [k for e in self.entities for k in e.join_keys]

    @property
    def field_names(self) -> list[str]:
        return [n for n, _ in self.fields]

    def typed_fields(self) -> list[Column]:
        """Cast to the declared types."""
        return [F.col(n).cast(t).alias(n) for n, t in self.fields]


@dataclass(frozen=True)
class FeatureService:
    """A named, reusable list of ``view:field`` references."""

    name: str
    refs: tuple[str, ...]


@dataclass
class Registry:
    views: dict[str, FeatureView] = field(default_factory=dict)

    def add(self, *views: FeatureView) -> "Registry":
        for v in views:
            self.views[v.name] = v
        return self

    def resolve(self, refs) -> dict[str, list[str]]:
        """P10: ``["view:field", ...]`` → {view: [field, ...]}; output names drop the prefix.

        Raises on unknown views/fields and on a field name requested from two views.
        """
        if isinstance(refs, FeatureService):
            refs = refs.refs
        out: dict[str, list[str]] = {}
        seen: dict[str, str] = {}
        for ref in refs:
            if ":" not in ref:
                raise ValueError(f"feature reference {ref!r} is not 'view:field'")
            view, fname = ref.split(":", 1)
            if view not in self.views:
                raise KeyError(f"unknown feature view {view!r}")
            if fname not in self.views[view].field_names:
                raise KeyError(f"view {view!r} has no field {fname!r}")
            if fname in seen and seen[fname] != view:
                raise ValueError(f"field {fname!r} requested from {seen[fname]!r} and {view!r}")
            seen[fname] = view
            out.setdefault(view, [])
            if fname not in out[view]:
                out[view].append(fname)
        return out


# The two driver views of the reference (names, TTLs, fields).
DRIVER = Entity("driver", ("driver_id",))
DRIVER_EVENTS = SourceSpec(path=None, timestamp_field="event_ts")
DRIVER_STATUS = FeatureView(
    name="driver_status", entities=(DRIVER,),
    fields=(("lat", "double"), ("lon", "double"), ("status", "string")),
    source=DRIVER_EVENTS, ttl=dt.timedelta(minutes=5))
DRIVER_AGG = FeatureView(
    name="driver_agg", entities=(DRIVER,),
    fields=(("accept_rate_7d", "double"), ("avg_response_ms", "double")),
    source=DRIVER_EVENTS, ttl=dt.timedelta(hours=1))
MATCH_FEATURES = FeatureService("match_features", (
    "driver_status:lat", "driver_status:lon",
    "driver_agg:accept_rate_7d", "driver_agg:avg_response_ms"))


def default_registry() -> Registry:
    return Registry().add(DRIVER_STATUS, DRIVER_AGG)
