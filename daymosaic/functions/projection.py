"""Transverse Mercator, zone 30 on GRS80, as column arithmetic (Krueger series in n).

Metres <-> degrees for the one zone the datasets use. The coefficients are the
published expansions to the fourth power of the third flattening.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

# Ellipsoid and zone.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
CENTRAL_MERIDIAN = -3.0
SCALE = 0.9996
FALSE_EASTING = 500000.0

N = FLATTENING / (2 - FLATTENING)
RADIUS = SEMI_MAJOR / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
ECCENTRICITY = 2 * math.sqrt(N) / (1 + N)

# Series coefficients, metres <- degrees, degrees <- metres, conformal -> geodetic.
FORWARD = (
    N / 2 - 2 / 3 * N**2 + 5 / 16 * N**3 + 41 / 180 * N**4,
    13 / 48 * N**2 - 3 / 5 * N**3 + 557 / 1440 * N**4,
    61 / 240 * N**3 - 103 / 140 * N**4,
    49561 / 161280 * N**4,
)
BACKWARD = (
    N / 2 - 2 / 3 * N**2 + 37 / 96 * N**3 - 1 / 360 * N**4,
    1 / 48 * N**2 + 1 / 15 * N**3 - 437 / 1440 * N**4,
    17 / 480 * N**3 - 37 / 840 * N**4,
    4397 / 161280 * N**4,
)
LATITUDE = (
    2 * N - 2 / 3 * N**2 - 2 * N**3 + 116 / 45 * N**4,
    7 / 3 * N**2 - 8 / 5 * N**3 - 227 / 45 * N**4,
    56 / 15 * N**3 - 136 / 35 * N**4,
    4279 / 630 * N**4,
)


def _series(coefficients, term):
    return sum(c * term(2.0 * j) for j, c in enumerate(coefficients, start=1))


def to_metres(lon, lat, m=F):
    """(easting, northing) of a longitude and latitude in degrees.

    Works on columns, and with ``m=math`` on plain numbers.
    """
    s = m.sin(m.radians(lat))
    lam = m.radians(lon - CENTRAL_MERIDIAN)
    t = m.sinh(m.atanh(s) - ECCENTRICITY * m.atanh(ECCENTRICITY * s))
    xi = m.atan2(t, m.cos(lam))
    eta = m.atanh(m.sin(lam) / m.sqrt(1.0 + t * t))
    east = eta + _series(FORWARD, lambda k: m.cos(k * xi) * m.sinh(k * eta))
    north = xi + _series(FORWARD, lambda k: m.sin(k * xi) * m.cosh(k * eta))
    return FALSE_EASTING + SCALE * RADIUS * east, SCALE * RADIUS * north


def to_degrees(x, y, m=F):
    """(longitude, latitude) of an easting and northing in metres."""
    xi = y / (SCALE * RADIUS)
    eta = (x - FALSE_EASTING) / (SCALE * RADIUS)
    xi0 = xi - _series(BACKWARD, lambda k: m.sin(k * xi) * m.cosh(k * eta))
    eta0 = eta - _series(BACKWARD, lambda k: m.cos(k * xi) * m.sinh(k * eta))
    chi = m.asin(m.sin(xi0) / m.cosh(eta0))
    lat = chi + _series(LATITUDE, lambda k: m.sin(k * chi))
    lon = m.degrees(m.atan2(m.sinh(eta0), m.cos(xi0))) + CENTRAL_MERIDIAN
    return lon, m.degrees(lat)
