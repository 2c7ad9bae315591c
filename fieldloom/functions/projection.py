"""Map projections as Column arithmetic: conic equal-area metres <-> degrees
<-> UTM metres (GRS80 ellipsoid, null datum shift)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 ellipsoid, CONUS equal-area cone (EPSG:5070), UTM.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
PARALLEL_1, PARALLEL_2 = math.radians(29.5), math.radians(45.5)
ORIGIN_LAT, ORIGIN_LON = math.radians(23.0), -96.0
UTM_SCALE, UTM_EASTING = 0.9996, 500000.0

E2 = FLATTENING * (2 - FLATTENING)
E = math.sqrt(E2)


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - E * s) / (1 + E * s)) / (2 * E))


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - E2 * math.sin(phi) ** 2)


# cone constants, from the standard parallels
CONE_N = (_m(PARALLEL_1) ** 2 - _m(PARALLEL_2) ** 2) / (_q(PARALLEL_2) - _q(PARALLEL_1))
CONE_C = _m(PARALLEL_1) ** 2 + CONE_N * _q(PARALLEL_1)
RHO_0 = SEMI_MAJOR * math.sqrt(CONE_C - CONE_N * _q(ORIGIN_LAT)) / CONE_N
Q_POLE = _q(math.pi / 2)

# authalic -> geodetic latitude series
AUTH_2 = E2 / 3 + 31 * E2**2 / 180 + 517 * E2**3 / 5040
AUTH_4 = 23 * E2**2 / 360 + 251 * E2**3 / 3780
AUTH_6 = 761 * E2**3 / 45360

# transverse Mercator series in the third flattening
N3 = FLATTENING / (2 - FLATTENING)
RECTIFYING = SEMI_MAJOR / (1 + N3) * (1 + N3**2 / 4 + N3**4 / 64)
TM_ALPHA = (N3 / 2 - 2 * N3**2 / 3 + 5 * N3**3 / 16,
            13 * N3**2 / 48 - 3 * N3**3 / 5,
            61 * N3**3 / 240)


def conus_to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:5070 metres -> longitude, latitude."""
    dy = F.lit(RHO_0) - y
    rho2 = x * x + dy * dy
    theta = F.atan2(x, dy)
    q = (F.lit(CONE_C) - rho2 * (CONE_N * CONE_N / SEMI_MAJOR**2)) / CONE_N
    beta = F.asin(q / Q_POLE)
    lat = (beta + AUTH_2 * F.sin(2 * beta) + AUTH_4 * F.sin(4 * beta)
           + AUTH_6 * F.sin(6 * beta))
    return F.degrees(theta / CONE_N) + ORIGIN_LON, F.degrees(lat)


def degrees_to_utm(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """Longitude, latitude -> easting, northing of a northern UTM zone."""
    lam = F.radians(lon - (zone * 6 - 183))
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - E * F.atanh(E * s))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(TM_ALPHA, start=1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    k = UTM_SCALE * RECTIFYING
    return UTM_EASTING + k * east, k * north


def conus_to_utm(x: Column, y: Column, zone: Column) -> tuple[Column, Column]:
    lon, lat = conus_to_degrees(x, y)
    return degrees_to_utm(lon, lat, zone)
