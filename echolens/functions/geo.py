"""Great-circle distance and bounding boxes as Spark columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088
KM_PER_DEGREE = math.pi * EARTH_RADIUS_KM / 180.0


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Haversine distance in km between two (lat, lng) points given in degrees."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dp = p2 - p1
    dl = F.radians(_c(lng2)) - F.radians(_c(lng1))
    sp, sl = F.sin(dp / 2), F.sin(dl / 2)
    a = sp * sp + F.cos(p1) * F.cos(p2) * (sl * sl)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))
