"""Point text to coordinates, and state-plane feet to latitude/longitude.

The conversion is the inverse Lambert conformal conic projection with two standard parallels
(J. P. Snyder, "Map Projections - A Working Manual", USGS Professional Paper 1395, 1987) for
EPSG:2263, evaluated as one column expression.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The point pattern, and the parameters of EPSG:2263 on the GRS80 ellipsoid.
POINT_PATTERN = r"POINT \((-?\d+\.?\d*)\s+(-?\d+\.?\d*)\)"
SEMI_MAJOR_M = 6378137.0
FLATTENING = 1 / 298.257222101
LATITUDE_ORIGIN = 40 + 10 / 60
LONGITUDE_ORIGIN = -74.0
PARALLEL_SOUTH = 40 + 40 / 60
PARALLEL_NORTH = 41 + 2 / 60
FALSE_EASTING_M = 300000.0
METRES_PER_FOOT = 1200 / 3937

_E = math.sqrt(FLATTENING * (2 - FLATTENING))


def _scale_at(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - (_E * math.sin(lat)) ** 2)


def _isometric(lat: float) -> float:
    s = _E * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


_SOUTH, _NORTH, _ORIGIN = (math.radians(d) for d in (PARALLEL_SOUTH, PARALLEL_NORTH, LATITUDE_ORIGIN))
CONE = math.log(_scale_at(_SOUTH) / _scale_at(_NORTH)) / math.log(_isometric(_SOUTH) / _isometric(_NORTH))
RADIUS_FACTOR_M = SEMI_MAJOR_M * _scale_at(_SOUTH) / (CONE * _isometric(_SOUTH) ** CONE)
RADIUS_ORIGIN_M = RADIUS_FACTOR_M * _isometric(_ORIGIN) ** CONE


def point_xy(wkt: Column) -> tuple[Column, Column]:
    """(x, y) of a WKT point as DOUBLE; null where the text is not a point."""
    return tuple(F.regexp_extract(wkt, POINT_PATTERN, i).try_cast("double") for i in (1, 2))


def _latitude(t: Column, rounds: int = 5) -> Column:
    def refine(lat: Column, _: int) -> Column:
        # (1 - s) / (1 + s) written so that ``lat`` occurs once and the expression grows linearly.
        shrink = 2 / (1 + F.sin(lat) * _E) - 1
        return F.lit(math.pi / 2) - 2 * F.atan(t * F.pow(shrink, F.lit(_E / 2)))

    return reduce(refine, range(rounds), F.lit(math.pi / 2) - 2 * F.atan(t))


def is_point(wkt: Column) -> Column:
    """Whether both coordinates can be read; cheaper in a filter than reading them."""
    return wkt.rlike(POINT_PATTERN)


def lon_lat(x_feet: Column, y_feet: Column) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees of a point in New York Long Island state-plane feet."""
    east = x_feet * METRES_PER_FOOT - FALSE_EASTING_M
    south = F.lit(RADIUS_ORIGIN_M) - y_feet * METRES_PER_FOOT
    t = F.pow(F.sqrt(east * east + south * south) / RADIUS_FACTOR_M, F.lit(1 / CONE))
    longitude = F.degrees(F.atan2(east, south) / CONE) + LONGITUDE_ORIGIN
    return longitude, F.degrees(_latitude(t))


def feet_xy(longitude: float, latitude: float) -> tuple[float, float]:
    """Forward projection of one point, for checks and fixtures."""
    radius = RADIUS_FACTOR_M * _isometric(math.radians(latitude)) ** CONE
    angle = CONE * math.radians(longitude - LONGITUDE_ORIGIN)
    x = FALSE_EASTING_M + radius * math.sin(angle)
    y = RADIUS_ORIGIN_M - radius * math.cos(angle)
    return x / METRES_PER_FOOT, y / METRES_PER_FOOT
