"""Geometry as column expressions: sphere vectors, longitude wrap, map-projection inverses.

Projection inverses follow the published ellipsoidal formulas (Snyder, Map Projections: A Working
Manual, USGS PP 1395, 1987).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sphere radius of the distance search, metres per degree, ellipsoids (a, b).
SPHERE_RADIUS_M = 6370997.0
METRES_PER_DEGREE = 112e3
WGS84 = (6378137.0, 6356752.314245179)
HUGHES_1980 = (6378273.0, 6356889.449)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def wrap_lon(lon: Column | str) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(_c(lon) + 180, F.lit(360.0)) - 180


def valid_position(lon: Column | str, lat: Column | str) -> Column:
    lo, la = _c(lon), _c(lat)
    return (
        lo.isNotNull() & la.isNotNull() & ~F.isnan(lo) & ~F.isnan(la)
        & la.between(-90, 90) & lo.between(-360, 360)
    )


def with_xyz(df: DataFrame, lon: str = "lon", lat: str = "lat", radius: float = SPHERE_RADIUS_M) -> DataFrame:
    """Add Cartesian ``x, y, z`` in metres on the search sphere."""
    lam, phi = F.radians(lon), F.radians(lat)
    return df.withColumns({
        "x": F.cos(phi) * F.cos(lam) * radius,
        "y": F.cos(phi) * F.sin(lam) * radius,
        "z": F.sin(phi) * radius,
    })


def chord(a: tuple, b: tuple) -> Column:
    """Straight-line distance in metres between two (x, y, z) triples, to the millimetre.

    Rounding makes distances that are equal on paper tie, so ties are broken by id and not by noise.
    """
    dx, dy, dz = (_c(p) - _c(q) for p, q in zip(a, b))
    return F.round(F.sqrt(dx * dx + dy * dy + dz * dz), 3)


# Keys of projection strings that are read or say nothing more; ellipsoids by name (a, b).
_KNOWN_KEYS = set("proj lon_0 lat_0 lat_ts x_0 y_0 a b R ellps datum units k k_0 no_defs wktext type".split())
ELLIPSOIDS = {
    "WGS84": WGS84, "GRS80": (6378137.0, 6356752.314140356), "WGS72": (6378135.0, 6356750.520016094),
    "clrk66": (6378206.4, 6356583.8), "bessel": (6377397.155, 6356078.962818189), "sphere": (6370997.0, 6370997.0),
}


def _ellipsoid(args: dict[str, str]) -> tuple[float, float]:
    """Axes given themselves, or those of a named ellipsoid or datum; WGS84 if none is."""
    if "R" in args:
        return float(args["R"]), float(args["R"])
    if "a" in args:
        return float(args["a"]), float(args.get("b", args["a"]))
    name = args.get("ellps") or args.get("datum") or "WGS84"
    if name not in ELLIPSOIDS:
        raise ValueError(f"unknown ellipsoid {name}")
    return ELLIPSOIDS[name]


@dataclass(frozen=True)
class Projection:
    """``kind`` is longlat, stere, laea or cea; angles in degrees."""

    kind: str
    ellipsoid: tuple[float, float] = WGS84
    lon_0: float = 0.0
    lat_0: float = 0.0
    lat_ts: float = 0.0
    x_0: float = 0.0
    y_0: float = 0.0

    @classmethod
    def parse(cls, text: str) -> "Projection":
        """Read a projection string as used in dataset configurations; what is not understood is refused."""
        code = text.strip().removeprefix("+init=").upper()
        # The two polar stereographic grid codes.
        if code == "EPSG:3411":
            return cls("stere", HUGHES_1980, lon_0=-45.0, lat_0=90.0, lat_ts=70.0)
        if code == "EPSG:3412":
            return cls("stere", HUGHES_1980, lon_0=0.0, lat_0=-90.0, lat_ts=-70.0)
        args = dict(re.findall(r"\+(\w+)(?:=(\S*))?", text))
        unknown = set(args) - _KNOWN_KEYS
        if unknown or args.get("units", "m") != "m" or any(float(args.get(k, 1)) != 1 for k in ("k", "k_0")):
            raise ValueError(f"unsupported settings in projection {text}: {sorted(unknown) or 'units or scale'}")
        kind = args.get("proj", "")
        if kind not in ("longlat", "laea", "cea", "stere"):
            raise ValueError(f"unsupported projection {text}")
        if kind == "laea" and abs(float(args.get("lat_0", 0))) != 90.0:
            raise ValueError("only polar azimuthal grids are supported")
        number = lambda key: float(args.get(key, 0))
        return cls(kind, _ellipsoid(args), number("lon_0"), number("lat_0"), number("lat_ts"), number("x_0"), number("y_0"))


def _ecc(ellipsoid: tuple[float, float]) -> float:
    a, b = ellipsoid
    return math.sqrt(1.0 - (b * b) / (a * a))


def _authalic_q(phi: float, e: float) -> float:
    s = math.sin(phi)
    return (1 - e * e) * (
        s / (1 - (e * s) ** 2) - math.log((1 - e * s) / (1 + e * s)) / (2 * e)
    )


def _lat_from_authalic(beta: Column, e: float) -> Column:
    """Geodetic from authalic latitude, series to e^6 (Snyder 3-18)."""
    e2, e4, e6 = e ** 2, e ** 4, e ** 6
    return (
        beta
        + F.sin(beta * 2) * (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040)
        + F.sin(beta * 4) * (23 * e4 / 360 + 251 * e6 / 3780)
        + F.sin(beta * 6) * (761 * e6 / 45360)
    )


def _lat_from_conformal(chi: Column, e: float) -> Column:
    """Geodetic from conformal latitude, series to e^8 (Snyder 3-5)."""
    e2, e4, e6, e8 = e ** 2, e ** 4, e ** 6, e ** 8
    return (
        chi
        + F.sin(chi * 2) * (e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360)
        + F.sin(chi * 4) * (7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520)
        + F.sin(chi * 6) * (7 * e6 / 120 + 81 * e8 / 1120)
        + F.sin(chi * 8) * (4279 * e8 / 161280)
    )


def inverse(proj: Projection, x: Column | str, y: Column | str) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of projected coordinates."""
    x, y = _c(x), _c(y)
    if proj.kind == "longlat":
        return x, y
    x, y = x - proj.x_0, y - proj.y_0
    a, _ = proj.ellipsoid
    e = max(_ecc(proj.ellipsoid), 1e-9)  # a sphere is the limit of the formulas
    q_pole = _authalic_q(math.pi / 2, e)
    north = 1.0 if proj.lat_0 >= 0 else -1.0
    if proj.kind == "stere":
        ts = math.radians(abs(proj.lat_ts))
        m = math.cos(ts) / math.sqrt(1 - (e * math.sin(ts)) ** 2)
        t_ts = math.tan(math.pi / 4 - ts / 2) / (
            (1 - e * math.sin(ts)) / (1 + e * math.sin(ts))
        ) ** (e / 2)
        rho = F.sqrt(x * x + y * y)
        t = rho * (t_ts / (a * m))
        phi = _lat_from_conformal(F.lit(math.pi / 2) - F.atan(t) * 2, e)
        lam = F.atan2(x, y * -north)
        return wrap_lon(F.degrees(lam) + proj.lon_0), F.degrees(phi) * north
    if proj.kind == "laea":
        rho2 = (x * x + y * y) / (a * a)
        beta = F.asin(F.lit(1.0) - rho2 / q_pole)
        lam = F.atan2(x, y * -north)
        return wrap_lon(F.degrees(lam) + proj.lon_0), F.degrees(_lat_from_authalic(beta, e)) * north
    if proj.kind == "cea":
        ts = math.radians(proj.lat_ts)
        k0 = math.cos(ts) / math.sqrt(1 - (e * math.sin(ts)) ** 2)
        sin_beta = y * (2 * k0 / (a * q_pole))
        beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sin_beta)))
        lam = x / (a * k0)
        return wrap_lon(F.degrees(lam) + proj.lon_0), F.degrees(_lat_from_authalic(beta, e))
    raise ValueError(f"unsupported projection {proj.kind}")
