"""Great-circle distance and a grid that finds near points by equality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Distance of two points given in degrees, as names or SQL expressions."""
    half = (
        f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) "
        f"* cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)"
    )
    return F.expr(f"{EARTH_RADIUS_KM}D * 2 * asin(sqrt({half}))")


def sphere_cells(lat: str, lon: str, size_km: float) -> list[Column]:
    """Cell of a point in a cubic grid laid through the globe.

    A chord is never longer than its arc, so two points within ``size_km`` of
    each other differ by at most one cell on each axis, at any latitude and
    across the date line.
    """
    axes = [
        f"cos(radians({lat})) * cos(radians({lon}))",
        f"cos(radians({lat})) * sin(radians({lon}))",
        f"sin(radians({lat}))",
    ]
    return [F.expr(f"floor({EARTH_RADIUS_KM / size_km!r}D * {a})") for a in axes]
