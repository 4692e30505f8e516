"""Coordinates of the city grid (transverse Mercator on Bessel) and of web Mercator to WGS84.

Each step is its own ``transform`` over the vertices, so that a step's result is computed once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from geosync.functions.geom import GEOMETRY, WGS84_A, WGS84_F

# SRID 980077, transverse Mercator with Bessel ellipsoid and seven-parameter shift.
LOCAL_SRID = 980077
LAT_0, LON_0 = 55.66666666667, 37.5
BESSEL_A, BESSEL_RF = 6377397.155, 299.1528128
SHIFT_M = (458.475, 0.244, 603.087)
SHIFT_ARCSEC = (-3.98169, -0.43293, 4.43381)
SHIFT_PPM = 1.713
WEB_RADIUS = 6378137.0

_RAD = math.pi / 180.0


def _meridian_arc(lat: float, a: float, e2: float) -> float:
    return a * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * lat
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * lat)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * lat)
        - (35 * e2**3 / 3072) * math.sin(6 * lat)
    )


def _vertex_steps_local(ring: Column) -> Column:
    a, f = BESSEL_A, 1 / BESSEL_RF
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    root = math.sqrt(1 - e2)
    e1 = (1 - root) / (1 + root)
    arc0 = _meridian_arc(LAT_0 * _RAD, a, e2)
    scale = a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256)

    rectified = F.transform(
        ring, lambda v: F.struct(v["x"].alias("x"), ((v["y"] + arc0) / scale).alias("mu"))
    )
    footpoint = F.transform(
        rectified,
        lambda v: F.struct(
            v["x"].alias("x"),
            (
                v["mu"]
                + F.sin(v["mu"] * 2) * (3 * e1 / 2 - 27 * e1**3 / 32)
                + F.sin(v["mu"] * 4) * (21 * e1**2 / 16 - 55 * e1**4 / 32)
                + F.sin(v["mu"] * 6) * (151 * e1**3 / 96)
                + F.sin(v["mu"] * 8) * (1097 * e1**4 / 512)
            ).alias("phi"),
        ),
    )
    local = F.transform(
        footpoint,
        lambda v: F.struct(
            v["phi"].alias("phi"),
            F.cos(v["phi"]).alias("cos"),
            F.tan(v["phi"]).alias("tan"),
            (F.tan(v["phi"]) * F.tan(v["phi"])).alias("t"),
            (F.cos(v["phi"]) * F.cos(v["phi"]) * ep2).alias("c"),
            (F.lit(1.0) - F.sin(v["phi"]) * F.sin(v["phi"]) * e2).alias("w"),
            v["x"].alias("x"),
        ),
    )
    sized = F.transform(
        local,
        lambda v: F.struct(
            *[v[k].alias(k) for k in ("phi", "cos", "tan", "t", "c")],
            (F.lit(a) / F.sqrt(v["w"])).alias("n"),
            (F.lit(a * (1 - e2)) / (v["w"] * F.sqrt(v["w"]))).alias("r"),
            (v["x"] / (F.lit(a) / F.sqrt(v["w"]))).alias("d"),
        ),
    )

    def geographic(v: Column) -> Column:
        d2 = v["d"] * v["d"]
        lat = v["phi"] - (v["n"] * v["tan"] / v["r"]) * (
            d2 / 2
            - d2 * d2 / 24 * (F.lit(5.0) + v["t"] * 3 + v["c"] * 10 - v["c"] * v["c"] * 4 - 9 * ep2)
            + d2 * d2 * d2 / 720
            * (F.lit(61.0) + v["t"] * 90 + v["c"] * 298 + v["t"] * v["t"] * 45 - 252 * ep2 - v["c"] * v["c"] * 3)
        )
        lon = F.lit(LON_0 * _RAD) + (
            v["d"]
            - d2 * v["d"] / 6 * (F.lit(1.0) + v["t"] * 2 + v["c"])
            + d2 * d2 * v["d"] / 120
            * (F.lit(5.0) - v["c"] * 2 + v["t"] * 28 - v["c"] * v["c"] * 3 + 8 * ep2 + v["t"] * v["t"] * 24)
        ) / v["cos"]
        return F.struct(lat.alias("lat"), lon.alias("lon"))

    bessel = F.transform(sized, geographic)
    return _to_degrees(_shift(_to_geocentric(bessel, a, e2)))


def _to_geocentric(positions: Column, a: float, e2: float) -> Column:
    with_n = F.transform(
        positions,
        lambda v: F.struct(
            v["lat"].alias("lat"),
            v["lon"].alias("lon"),
            (F.lit(a) / F.sqrt(F.lit(1.0) - F.sin(v["lat"]) * F.sin(v["lat"]) * e2)).alias("n"),
        ),
    )
    return F.transform(
        with_n,
        lambda v: F.struct(
            (v["n"] * F.cos(v["lat"]) * F.cos(v["lon"])).alias("x"),
            (v["n"] * F.cos(v["lat"]) * F.sin(v["lon"])).alias("y"),
            (v["n"] * (1 - e2) * F.sin(v["lat"])).alias("z"),
        ),
    )


def _shift(positions: Column) -> Column:
    """Seven parameters, position-vector rotation."""
    dx, dy, dz = SHIFT_M
    rx, ry, rz = (angle / 3600 * _RAD for angle in SHIFT_ARCSEC)
    m = 1 + SHIFT_PPM * 1e-6
    return F.transform(
        positions,
        lambda v: F.struct(
            ((v["x"] - v["y"] * rz + v["z"] * ry) * m + dx).alias("x"),
            ((v["x"] * rz + v["y"] - v["z"] * rx) * m + dy).alias("y"),
            ((v["y"] * rx - v["x"] * ry + v["z"]) * m + dz).alias("z"),
        ),
    )


def _to_degrees(positions: Column) -> Column:
    a = WGS84_A
    e2 = WGS84_F * (2 - WGS84_F)
    b = a * (1 - WGS84_F)
    ep2 = e2 / (1 - e2)
    polar = F.transform(
        positions,
        lambda v: F.struct(
            F.atan2(v["y"], v["x"]).alias("lon"),
            v["z"].alias("z"),
            F.sqrt(v["x"] * v["x"] + v["y"] * v["y"]).alias("p"),
        ),
    )
    angled = F.transform(
        polar,
        lambda v: F.struct(
            v["lon"].alias("lon"), v["z"].alias("z"), v["p"].alias("p"),
            F.atan2(v["z"] * a, v["p"] * b).alias("u"),
        ),
    )
    return F.transform(
        angled,
        lambda v: F.struct(
            (v["lon"] / _RAD).alias("x"),
            (
                F.atan2(
                    v["z"] + F.sin(v["u"]) * F.sin(v["u"]) * F.sin(v["u"]) * (ep2 * b),
                    v["p"] - F.cos(v["u"]) * F.cos(v["u"]) * F.cos(v["u"]) * (e2 * a),
                )
                / _RAD
            ).alias("y"),
        ),
    )


def _vertex_steps_web(ring: Column) -> Column:
    return F.transform(
        ring,
        lambda v: F.struct(
            (v["x"] / WEB_RADIUS / _RAD).alias("x"),
            ((F.atan(F.exp(v["y"] / WEB_RADIUS)) * 2 - math.pi / 2) / _RAD).alias("y"),
        ),
    )


_STEPS = {LOCAL_SRID: _vertex_steps_local, 3857: _vertex_steps_web}


def reproject(geom: Column, from_srid: int) -> Column:
    """Geometry in WGS84 from one of the two source grids; WGS84 passes through."""
    if from_srid == 4326:
        return geom
    steps = _STEPS[from_srid]
    parts = F.transform(
        geom["parts"],
        lambda p: F.struct(
            p["kind"].alias("kind"),
            p["member"].alias("member"),
            F.transform(p["rings"], steps).alias("rings"),
        ),
    )
    made = F.struct(geom["kind"].alias("kind"), parts.alias("parts"), F.lit(4326).alias("srid"))
    return F.when(geom["kind"].isNotNull(), made.cast(GEOMETRY))
