"""Projections as closed-form column expressions, forth and back.

EPSG:4326 (degrees), 3857 (spherical Mercator), 3035 (Lambert azimuthal equal area, Europe) and
25829 to 25831 (transverse Mercator, zones 29 to 31). Points pass as (x, y) columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KNOWN = ("EPSG:3035", "EPSG:4326", "EPSG:3857", "EPSG:25829", "EPSG:25830", "EPSG:25831")
# The GRS 80 ellipsoid, and the sphere's radius of web Mercator.
A, FLATTENING, SPHERE = 6378137.0, 1 / 298.257222101, 6378137.0
E2 = FLATTENING * (2 - FLATTENING)
E1 = math.sqrt(E2)
N = FLATTENING / (2 - FLATTENING)
# Fixed values of EPSG:3035: origin and false easting and northing.
LAEA_LAT, LAEA_LON, LAEA_X, LAEA_Y = math.radians(52), math.radians(10), 4321000.0, 3210000.0
TM_SCALE, TM_X = 0.9996, 500000.0


def _q(sine):
    log = F.log if isinstance(sine, Column) else math.log
    return (sine / (1 - E2 * sine * sine) - log((1 - E1 * sine) / (1 + E1 * sine)) / (2 * E1)) * (1 - E2)


_QP = _q(1.0)
_RQ = A * math.sqrt(_QP / 2)
_B0 = math.asin(_q(math.sin(LAEA_LAT)) / _QP)
_D = A * (math.cos(LAEA_LAT) / math.sqrt(1 - E2 * math.sin(LAEA_LAT) ** 2)) / (_RQ * math.cos(_B0))


def _laea_start(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.asin(_q(F.sin(F.radians(lat))) / _QP), F.radians(lon) - LAEA_LON


def _laea_end(beta: Column, d: Column) -> tuple[Column, Column]:
    b = F.sqrt(F.lit(2.0) / (F.sin(beta) * math.sin(_B0) + 1 + F.cos(beta) * F.cos(d) * math.cos(_B0))) * _RQ
    return b * _D * F.cos(beta) * F.sin(d) + LAEA_X, b / _D * (F.sin(beta) * math.cos(_B0) - F.cos(beta) * F.cos(d) * math.sin(_B0)) + LAEA_Y


def _laea_polar(x: Column, y: Column) -> tuple[Column, Column, Column, Column]:
    dx, dy = (x - LAEA_X) / _D, (y - LAEA_Y) * _D
    rho = F.sqrt(dx * dx + dy * dy)
    return dx, dy, rho, F.asin(rho / (2 * _RQ)) * 2


def _laea_sphere(dx: Column, dy: Column, rho: Column, c: Column) -> tuple[Column, Column]:
    at_origin = rho < 1e-9
    beta = F.when(at_origin, _B0).otherwise(F.asin(F.cos(c) * math.sin(_B0) + F.try_divide(dy * F.sin(c) * math.cos(_B0), rho)))
    lon = F.when(at_origin, 0.0).otherwise(F.atan2(dx * F.sin(c), rho * math.cos(_B0) * F.cos(c) - dy * math.sin(_B0) * F.sin(c)))
    return lon, beta


def _laea_degrees(lon: Column, beta: Column) -> tuple[Column, Column]:
    e4, e6 = E2 * E2, E2 * E2 * E2
    lat = beta + F.sin(2 * beta) * (E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) + F.sin(4 * beta) * (23 * e4 / 360 + 251 * e6 / 3780) + F.sin(6 * beta) * (761 * e6 / 45360)
    return F.degrees(lon + LAEA_LON), F.degrees(lat)


def _from_degrees_3035(lon: Column, lat: Column) -> tuple[Column, Column]:
    return _laea_end(*_laea_start(lon, lat))


def _to_degrees_3035(x: Column, y: Column) -> tuple[Column, Column]:
    return _laea_degrees(*_laea_sphere(*_laea_polar(x, y)))


def _from_degrees_3857(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * SPHERE, F.log(F.tan(F.radians(lat) / 2 + math.pi / 4)) * SPHERE


def _to_degrees_3857(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / SPHERE), F.degrees(F.atan(F.exp(y / SPHERE)) * 2 - math.pi / 2)


# Krueger's series in the third flattening, to the fourth power.
_RECTIFYING = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
_ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180, 13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440, 61 * N**3 / 240 - 103 * N**4 / 140, 49561 * N**4 / 161280)
_BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360, N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440, 17 * N**3 / 480 - 37 * N**4 / 840, 4397 * N**4 / 161280)
_DELTA = (2 * N - 2 * N**2 / 3 - 2 * N**3 + 116 * N**4 / 45, 7 * N**2 / 3 - 8 * N**3 / 5 - 227 * N**4 / 45, 56 * N**3 / 15 - 136 * N**4 / 35, 4279 * N**4 / 630)


def _meridian(zone: int) -> float:
    return math.radians(6 * zone - 183)


def _tm_start(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    s, d = F.sin(F.radians(lat)), F.radians(lon) - _meridian(zone)
    t = F.sinh(F.atanh(s) - F.atanh(s * E1) * E1)
    return F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(t * t + 1))


def _tm_series(xi: Column, eta: Column, factors: tuple[float, ...]) -> tuple[Column, Column]:
    north, east = xi, eta
    for j, a in enumerate(factors, 1):
        north = north + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a
        east = east + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a
    return north, east


def _tm_end(north: Column, east: Column, zone: int) -> tuple[Column, Column]:
    chi = F.asin(F.sin(north) / F.cosh(east))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + F.sin(chi * (2 * j)) * d
    return F.degrees(F.atan2(F.sinh(east), F.cos(north)) + _meridian(zone)), F.degrees(lat)


def _from_degrees_tm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    north, east = _tm_series(*_tm_start(lon, lat, zone), _ALPHA)
    return east * (TM_SCALE * _RECTIFYING) + TM_X, north * (TM_SCALE * _RECTIFYING)


def _to_degrees_tm(x: Column, y: Column, zone: int) -> tuple[Column, Column]:
    xi, eta = y / (TM_SCALE * _RECTIFYING), (x - TM_X) / (TM_SCALE * _RECTIFYING)
    return _tm_end(*_tm_series(xi, eta, tuple(-b for b in _BETA)), zone)


def _columns(df: DataFrame, names: tuple[str, ...], values: tuple[Column, ...]) -> tuple[DataFrame, list[Column]]:
    return df.withColumns(dict(zip(names, values, strict=True))), [F.col(n) for n in names]


def _tm_series_by_columns(df: DataFrame, xi: Column, eta: Column, factors: tuple[float, ...]) -> tuple[DataFrame, Column, Column]:
    """df with columns in between, and what ``_tm_series`` gives: sines of multiples are made of those of twice the angle, so four functions are called instead of sixteen."""
    df, (s2, c2, h2, k2) = _columns(df, ("tm_s2", "tm_c2", "tm_h2", "tm_k2"), (F.sin(xi * 2), F.cos(xi * 2), F.sinh(eta * 2), F.cosh(eta * 2)))
    df, (s4, c4, h4, k4) = _columns(df, ("tm_s4", "tm_c4", "tm_h4", "tm_k4"), (s2 * c2 * 2, F.lit(1.0) - s2 * s2 * 2, h2 * k2 * 2, h2 * h2 * 2 + 1))
    sines, cosines = (s2, s4, s4 * c2 + c4 * s2, s4 * c4 * 2), (c2, c4, c4 * c2 - s4 * s2, F.lit(1.0) - s4 * s4 * 2)
    sinhs, coshs = (h2, h4, h4 * k2 + k4 * h2, h4 * k4 * 2), (k2, k4, k4 * k2 + h4 * h2, h4 * h4 * 2 + 1)
    north, east = xi, eta
    for a, s, c, h, k in zip(factors, sines, cosines, sinhs, coshs, strict=False):
        north, east = north + s * k * a, east + c * h * a
    return df, north, east


def with_transformed(df: DataFrame, x: str, y: str, source: str, target: str, out_x: str, out_y: str) -> DataFrame:
    """df with the point in the target system, as ``transform`` gives it, for tables of many points.

    The series go by columns in between, and the point comes out of a generator: later filters and joins on it would
    otherwise be moved below, each with a copy of the whole formula, until the code of a stage is too long to compile.
    """
    for name in (source, target):
        if name not in KNOWN:
            raise ValueError(f"{name} is not one of {', '.join(KNOWN)}")
    kept, k, at = df.columns, TM_SCALE * _RECTIFYING, (F.col(x), F.col(y))
    if source == target:
        return df.withColumns({out_x: at[0], out_y: at[1]})
    if source == "EPSG:3035":
        df, polar = _columns(df, ("laea_dx", "laea_dy", "laea_rho", "laea_c"), _laea_polar(*at))
        df, sphere = _columns(df, ("laea_lon", "laea_beta"), _laea_sphere(*polar))
        at = _laea_degrees(*sphere)
    elif source.startswith("EPSG:258"):
        df, series = _columns(df, ("tm_xi", "tm_eta"), (at[1] / k, (at[0] - TM_X) / k))
        df, *ends = _tm_series_by_columns(df, *series, tuple(-b for b in _BETA))
        df, ends = _columns(df, ("tm_north", "tm_east"), tuple(ends))
        at = _tm_end(*ends, int(source[-2:]))
    elif source == "EPSG:3857":
        at = _to_degrees_3857(*at)
    df, at = _columns(df, ("lon_between", "lat_between"), tuple(at))
    if target == "EPSG:3035":
        df, start = _columns(df, ("laea_beta_to", "laea_d_to"), _laea_start(*at))
        at = _laea_end(*start)
    elif target.startswith("EPSG:258"):
        df, start = _columns(df, ("tm_xi_to", "tm_eta_to"), _tm_start(*at, int(target[-2:])))
        df, north, east = _tm_series_by_columns(df, *start, _ALPHA)
        at = east * k + TM_X, north * k
    elif target == "EPSG:3857":
        at = _from_degrees_3857(*at)
    point = F.inline(F.array(F.struct(at[0].alias(out_x), at[1].alias(out_y))))
    return df.select(*[F.col(c) for c in kept if c not in (out_x, out_y)], point)


def transform(x: Column, y: Column, source: str, target: str) -> tuple[Column, Column]:
    """The point in the target system; degrees are (longitude, latitude). Unknown systems are an error."""
    for name in (source, target):
        if name not in KNOWN:
            raise ValueError(f"{name} is not one of {', '.join(KNOWN)}")
    if source == target:
        return x, y
    if source != "EPSG:4326":
        x, y = _to_degrees_3857(x, y) if source == "EPSG:3857" else _to_degrees_3035(x, y) if source == "EPSG:3035" else _to_degrees_tm(x, y, int(source[-2:]))
    if target == "EPSG:4326":
        return x, y
    return _from_degrees_3857(x, y) if target == "EPSG:3857" else _from_degrees_3035(x, y) if target == "EPSG:3035" else _from_degrees_tm(x, y, int(target[-2:]))
