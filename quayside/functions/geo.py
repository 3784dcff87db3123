"""Positions, distances and paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside import config


def to_radians(lat: Column, lon: Column) -> tuple[Column, Column]:
    return F.radians(lat), F.radians(lon)


def to_degrees(lat_rad: Column, lon_rad: Column) -> tuple[Column, Column]:
    return F.degrees(lat_rad), F.degrees(lon_rad)


def planar_km_of_radians(y1: Column, x1: Column, y2: Column, x2: Column) -> Column:
    dy, dx = y1 - y2, x1 - x2
    return F.sqrt(dy * dy + dx * dx) * F.lit(config.EARTH_RADIUS_KM)


def haversine_km_of_radians(y1: Column, x1: Column, y2: Column, x2: Column) -> Column:
    sin_dy, sin_dx = F.sin((y2 - y1) / 2), F.sin((x2 - x1) / 2)
    a = sin_dy * sin_dy + F.cos(y1) * F.cos(y2) * sin_dx * sin_dx
    # The root is held at 1: rounding can pass it near antipodes.
    return F.lit(2 * config.EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def planar_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Straight distance in the (lat, lon) plane in radians, times the earth's radius.

    East-west distances are not shrunk with latitude and do not wrap at 180 degrees. This is the
    distance ports are matched by.
    """
    return planar_km_of_radians(*map(F.radians, (lat1, lon1, lat2, lon2)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    return haversine_km_of_radians(*map(F.radians, (lat1, lon1, lat2, lon2)))


def km_to_nm(km: Column) -> Column:
    return km / F.lit(config.KM_PER_NM)


def expected_hours(distance_nm: Column, speed_kn: float = config.DEFAULT_SPEED_KN) -> Column:
    """Hours at a steady speed, to 2 decimals; null for an unknown or zero distance."""
    return F.when(distance_nm != 0, F.round(distance_nm / F.lit(float(speed_kn)), 2))


def line_string(*points: tuple[Column, Column]) -> Column:
    """GeoJSON line through (lat, lon) points; coordinates are written (lon, lat)."""
    return F.struct(
        F.lit("LineString").alias("type"),
        F.array(*[F.array(lon.cast("double"), lat.cast("double")) for lat, lon in points]).alias("coordinates"),
    )


def is_path(geometry: Column) -> Column:
    """A usable geometry has two points or more. Null geometries and coordinates give false."""
    return F.coalesce(F.size(geometry["coordinates"]) >= 2, F.lit(False))


def downsample_path(points: Column) -> Column:
    """Thin long paths: keep every 3rd point above 100, every 2nd above 30, and the last one."""
    n = F.size(points)
    step = (
        F.when(n > config.LONG_PATH_POINTS, config.LONG_PATH_KEEP_EVERY)
        .when(n > config.MEDIUM_PATH_POINTS, config.MEDIUM_PATH_KEEP_EVERY)
        .otherwise(1)
    )
    return F.filter(points, lambda _, i: (i % step == 0) | (i == n - 1))


def round_coordinate(value: Column, decimals: int = config.COORDINATE_DECIMALS) -> Column:
    return F.round(value, decimals)
