"""Planar geometry as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_008.8


def squared_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared distance of two points; NULL when either point is missing."""
    return (x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)


def within(d2: Column, radius: float) -> Column:
    """True when a squared distance is at most ``radius`` (the bound is included)."""
    return d2 <= radius * radius


def project_xy(lon: Column, lat: Column, lon0: float, lat0: float) -> tuple[Column, Column]:
    """Degrees to metres east and north of (lon0, lat0), equirectangular.

    Good to about 0.1 % over a metropolitan area, enough to rank distances there.
    """
    x = F.radians(lon - F.lit(lon0)) * F.cos(F.radians(F.lit(lat0))) * EARTH_RADIUS_M
    y = F.radians(lat - F.lit(lat0)) * EARTH_RADIUS_M
    return x, y


def gap_to_range(value: Column, low: Column, high: Column) -> Column:
    """How far ``value`` lies outside [low, high]; 0 inside."""
    return F.greatest(low - value, value - high, F.lit(0))


def reach_over_range(value: Column, low: Column, high: Column) -> Column:
    """Distance from ``value`` to the farther end of [low, high]."""
    return F.greatest(F.abs(value - low), F.abs(value - high))
