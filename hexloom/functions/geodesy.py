"""Distances and areas on the WGS84 ellipsoid."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .projection import to_wgs84

A, FLATTENING = 6378137.0, 1 / 298.257223563
B = A * (1 - FLATTENING)
E2 = FLATTENING * (2 - FLATTENING)


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = 6371008.8) -> Column:
    """Distance in metres on a sphere."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.asin(F.sqrt(F.least(F.lit(1.0), h))) * (2 * radius)


def geodesic_m(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """Distances in metres on the ellipsoid by Vincenty's inverse formula, for whole arrays of degrees at once.

    Nearly antipodal places, for which the rounds don't settle, get the distance on a sphere.
    """
    lon1, lat1, lon2, lat2 = (np.radians(np.asarray(v, float)) for v in (lon1, lat1, lon2, lat2))
    u1, u2 = np.arctan((1 - FLATTENING) * np.tan(lat1)), np.arctan((1 - FLATTENING) * np.tan(lat2))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    diff = lon2 - lon1
    lam = diff
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(12):
            sl, cl = np.sin(lam), np.cos(lam)
            sin_sigma = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
            cos_sigma = s1 * s2 + c1 * c2 * cl
            sigma = np.arctan2(sin_sigma, cos_sigma)
            sin_alpha = np.where(sin_sigma == 0, 0.0, c1 * c2 * sl / sin_sigma)
            cos2 = 1 - sin_alpha**2
            mid = np.where(cos2 == 0, 0.0, cos_sigma - 2 * s1 * s2 / cos2)
            c = FLATTENING / 16 * cos2 * (4 + FLATTENING * (4 - 3 * cos2))
            before, lam = lam, diff + (1 - c) * FLATTENING * sin_alpha * (sigma + c * sin_sigma * (mid + c * cos_sigma * (2 * mid**2 - 1)))
    w = cos2 * (A * A - B * B) / (B * B)
    big_a = 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w)))
    big_b = w / 1024 * (256 + w * (-128 + w * (74 - 47 * w)))
    q = 2 * mid**2 - 1
    delta = big_b * sin_sigma * (mid + big_b / 4 * (cos_sigma * q - big_b / 6 * mid * (4 * sin_sigma**2 - 3) * (4 * mid**2 - 3)))
    h = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin(diff / 2) ** 2
    sphere = 2 * 6371008.8 * np.arcsin(np.sqrt(np.minimum(h, 1)))
    return np.where(np.abs(lam - before) > 1e-9, sphere, B * big_a * (sigma - delta))


@F.pandas_udf(DoubleType())
def geodesic(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    """``geodesic_m`` of columns; a null place has no distance."""
    return pd.Series(geodesic_m(lon1, lat1, lon2, lat2))


def geodesic_of_projected(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Ground distance in metres between two projected places."""
    (lon1, lat1), (lon2, lat2) = to_wgs84(x1, y1), to_wgs84(x2, y2)
    return geodesic(lon1, lat1, lon2, lat2)


def dateline_safe(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The smaller of the ground distances as given and with one place moved by a world width."""
    from .projection import WORLD

    moved = [geodesic_of_projected(x1 + s * WORLD, y1, x2, y2) for s in (-1, 0, 1)]
    return F.least(*moved)


def hex_ground_area_km2(flat_to_flat: float, lat: Column) -> Column:
    """Ground area of a cell at a latitude: its plane area times the squared cosine."""
    return F.lit(math.sqrt(3) / 2 * flat_to_flat**2 / 1e6) * F.pow(F.cos(F.radians(lat)), 2)


def ring_km2(x: np.ndarray, y: np.ndarray, steps: int = 32) -> float:
    """Area on the ellipsoid in square kilometres of a ring of projected corners, whichever way round it goes.

    Under a side, which is straight in the projection, the area between it and the equator is summed over
    ``steps`` parts with the authalic function of the latitude.
    """
    e, part = math.sqrt(E2), np.arange(steps + 1) / steps
    s = np.sin(np.arctan(np.sinh((y[:, None] + (np.roll(y, -1) - y)[:, None] * part) / A)))
    q = (1 - E2) * (s / (1 - E2 * s * s) + np.log((1 + e * s) / (1 - e * s)) / (2 * e))
    under = ((q[:, 1:] + q[:, :-1]) / 2).mean(axis=1) * (np.roll(x, -1) - x) / A
    return abs(float(under.sum())) * A**2 / 2 / 1e6
