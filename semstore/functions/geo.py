"""Geographic predicates on STRUCT<lon, lat> columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0


def in_box(lon: Column, lat: Column, left: float, top: float, right: float, bottom: float) -> Column:
    """Inside a box; one whose left side lies east of its right side crosses the antimeridian."""
    inside_lat = (lat <= top) & (lat >= bottom)
    if left <= right:
        return inside_lat & (lon >= left) & (lon <= right)
    return inside_lat & ((lon >= left) | (lon <= right))


def distance_m(lon: Column, lat: Column, lon0: float, lat0: float) -> Column:
    """Great-circle distance in metres to a fixed point."""
    half_lat = F.radians(lat - F.lit(lat0)) / 2
    half_lon = F.radians(lon - F.lit(lon0)) / 2
    a = F.pow(F.sin(half_lat), 2) + F.lit(math.cos(math.radians(lat0))) * F.cos(F.radians(lat)) * F.pow(
        F.sin(half_lon), 2
    )
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def within_radius(lon: Column, lat: Column, lon0: float, lat0: float, radius_m: float) -> Column:
    """Within a distance; plain comparisons on the coordinates come first, for the scan to use."""
    near = distance_m(lon, lat, lon0, lat0) <= radius_m
    angle = math.degrees(radius_m / EARTH_RADIUS_M) * (1 + 1e-9) + 1e-9
    if angle >= 90:
        return near
    near_lat = (lat >= lat0 - angle) & (lat <= lat0 + angle)
    spread = math.sin(math.radians(angle)) / max(math.cos(math.radians(lat0)), 1e-12)
    if abs(lat0) + angle >= 90 or spread >= 1:
        return near_lat & near
    d_lon = math.degrees(math.asin(spread)) * (1 + 1e-9) + 1e-9
    left, right = lon0 - d_lon, lon0 + d_lon
    if left >= -180 and right <= 180:
        return near_lat & (lon >= left) & (lon <= right) & near
    left, right = (left + 360 if left < -180 else left), (right - 360 if right > 180 else right)
    return near_lat & ((lon >= left) | (lon <= right)) & near
