"""Coordinates and great-circle distance."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def decimal_degrees(degrees: Column, minutes: Column) -> Column:
    return degrees.cast("double") + minutes.cast("double") / F.lit(60.0)


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance between two points given in decimal degrees."""
    lat1, lon1, lat2, lon2 = (F.radians(c) for c in (lat1, lon1, lat2, lon2))
    half_chord = F.pow(F.sin((lat2 - lat1) / 2), 2.0) + F.cos(lat1) * F.cos(lat2) * F.pow(
        F.sin((lon2 - lon1) / 2), 2.0
    )
    return 2.0 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(half_chord, F.lit(1.0))))


def check_coordinates(latitude: float, longitude: float) -> tuple[float, float]:
    """The arguments as floats; out of range, NULL and NaN are errors, also when no row is read."""
    for name, value, limit in (("latitude", latitude, 90), ("longitude", longitude, 180)):
        if value is None or math.isnan(value) or not -limit <= value <= limit:
            raise ValueError(f"{name} must be between -{limit} and {limit}")
    return float(latitude), float(longitude)
