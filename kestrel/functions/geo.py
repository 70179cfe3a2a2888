"""Numeric column functions: great-circle distance and null-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km used by the distance feature.
EARTH_RADIUS_KM = 6371.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; NULL if any coordinate is NULL."""
    la1, lo1, la2, lo2 = (_c(x) for x in (lat1, lon1, lat2, lon2))
    dlat = F.radians(la2 - la1)
    dlon = F.radians(lo2 - lo1)
    a = (F.sin(dlat / 2) * F.sin(dlat / 2)
         + F.cos(F.radians(la1)) * F.cos(F.radians(la2)) * F.sin(dlon / 2) * F.sin(dlon / 2))
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


def safe_ln(x) -> Column:
    """Natural log, NULL for non-positive or NULL input."""
    v = _c(x)
    return F.when(v > 0, F.ln(v))


def add_const(x, k) -> Column:
    """Null-safe ``x + k``."""
    return _c(x) + F.lit(k)


def int_part(x) -> Column:
    """Integer part (truncation toward zero); NULL when out of range."""
    return _c(x).try_cast("bigint")
