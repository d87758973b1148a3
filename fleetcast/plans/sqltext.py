"""SQL fragments shared by the oracle queries (DuckDB dialect, ANSI where possible)."""

from __future__ import annotations

from fleetcast.functions.scoring import Ranker


def num(x: float) -> str:
    """A DOUBLE literal (DuckDB reads plain decimals as DECIMAL)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"12742.0 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * "
            f"pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))")


def logit_sql(r: Ranker, cols: dict[str, str]) -> str:
    expr = num(r.intercept)
    for f in r.features:
        c = cols.get(f, f)
        if f in r.impute:
            c = f"coalesce({c}, {num(r.impute[f])})"
        expr = f"({expr} + {num(r.weights[f])} * {c})"
    return expr


def score_sql(r: Ranker, cols: dict[str, str]) -> str:
    return f"(1.0 / (1.0 + exp(-{logit_sql(r, cols)})))"


LATEST_DRIVER_SQL = """
SELECT driver_id, event_id, event_type, event_ts, lat, lon, status, accept_rate_7d, avg_response_ms
FROM (SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY event_ts DESC, event_id DESC) AS rn_
      FROM fx_driver_events WHERE driver_id IS NOT NULL AND event_ts IS NOT NULL) t
WHERE rn_ = 1"""
