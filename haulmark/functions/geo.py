"""Distance between GPS points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2.0)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2.0)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)) * (2.0 * EARTH_RADIUS_KM)
