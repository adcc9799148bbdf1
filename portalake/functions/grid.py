"""Latitude/longitude to forecast grid cell (Lambert conformal conic)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published definition of the 5 km forecast grid.
EARTH_RADIUS_KM = 6371.00877
CELL_KM = 5.0
STANDARD_LATITUDES = (30.0, 60.0)
ORIGIN_LON, ORIGIN_LAT = 126.0, 38.0
ORIGIN_X, ORIGIN_Y = 43, 136


def _half_colatitude(lat_degrees: float) -> float:
    return math.tan(math.pi / 4 + math.radians(lat_degrees) / 2)


def _cone() -> tuple[float, float, float]:
    """Cone exponent, scale in cells, and distance from apex to the origin in cells."""
    low, high = STANDARD_LATITUDES
    n = (math.log(math.cos(math.radians(low)) / math.cos(math.radians(high)))
         / math.log(_half_colatitude(high) / _half_colatitude(low)))
    scale = (EARTH_RADIUS_KM / CELL_KM) * math.cos(math.radians(low)) / n * _half_colatitude(low) ** n
    return n, scale, scale / _half_colatitude(ORIGIN_LAT) ** n


CONE, SCALE, ORIGIN_DISTANCE = _cone()


def position(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Unrounded grid coordinates, half a cell added; NULL outside the projection."""
    valid = (lat > -90) & (lat < 90) & (F.abs(lon) < float("inf"))
    distance = F.when(valid, SCALE / F.pow(F.tan(math.pi / 4 + F.radians(lat) / 2), F.lit(CONE)))
    turn = F.radians(lon) - math.radians(ORIGIN_LON)
    # Nearest whole number of turns off, halves to even.
    angle = (turn - 2 * math.pi * F.rint(turn / (2 * math.pi))) * CONE
    return (distance * F.sin(angle) + (ORIGIN_X + 0.5),
            ORIGIN_DISTANCE - distance * F.cos(angle) + (ORIGIN_Y + 0.5))


def grid_cell(lat: Column, lon: Column, strict: bool = False) -> Column:
    """``STRUCT<nx INT, ny INT>``. Any finite longitude is folded into range. A latitude at or
    past a pole, or a value that is not finite, gives NULL, or an error when ``strict``."""
    x, y = position(lat, lon)
    bad = F.raise_error(F.lit("latitude or longitude out of range")) if strict else F.lit(None)
    return F.when(x.isNotNull(), F.struct(x.cast("int").alias("nx"), y.cast("int").alias("ny"))
                  ).otherwise(bad)
