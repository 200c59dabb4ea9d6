"""Longitude and latitude to Web Mercator metres and back, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS = 6378137.0
WORLD = 2 * math.pi * RADIUS
#: Half the extent of the projected world.
HALF_EXTENT = 20037508.342789244


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Projected x and y of degrees."""
    return F.radians(lon) * RADIUS, F.log(F.tan(math.pi / 4 + F.radians(lat) / 2)) * RADIUS


def to_wgs84(x: Column, y: Column) -> tuple[Column, Column]:
    """Degrees of projected x and y."""
    return F.degrees(x / RADIUS), F.degrees(F.atan(F.sinh(y / RADIUS)))


def bbox_to_mercator(west: float, south: float, east: float, north: float) -> tuple[float, float, float, float]:
    """A box of degrees in projected metres."""
    y = [RADIUS * math.log(math.tan(math.pi / 4 + math.radians(v) / 2)) for v in (south, north)]
    return RADIUS * math.radians(west), y[0], RADIUS * math.radians(east), y[1]


def analysis_x(x: Column, centre_x: Column, crosses_dateline: Column) -> Column:
    """x in a frame that is whole across the date line: western pieces move one world width east."""
    return F.when(crosses_dateline & (centre_x < 0), x + WORLD).otherwise(x)
