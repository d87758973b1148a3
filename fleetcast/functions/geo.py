"""Geographic column expressions (JVM-side, whole-stage codegen friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres used by the great-circle formula.
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = EARTH_RADIUS_KM * math.pi / 180.0


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km between two points given in degrees.

    ``2 R asin(sqrt(sin²(Δφ/2) + cos φ1 cos φ2 sin²(Δλ/2)))``.  Any null
    input gives null.
    """
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dlam = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlam / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def unpack_point(arr, lat_name: str = "lat", lon_name: str = "lon") -> list[Column]:
    """``[lat, lon]`` array → two columns; arrays of any other size → nulls."""
    a = _c(arr)
    ok = F.size(a) == 2
    return [F.when(ok, F.element_at(a, 1).cast("double")).alias(lat_name),
            F.when(ok, F.element_at(a, 2).cast("double")).alias(lon_name)]
