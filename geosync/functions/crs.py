"""Positions of projected coordinate systems in WGS84, by code: one engine, the systems are parameters.

A system is an ellipsoid, a projection and a shift to WGS84. Inverse transverse Mercator goes by the series in the third
flattening to its sixth power, the conic by iteration, the shift over geocentric coordinates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from geosync.functions import planar
from geosync.functions.reproject import BESSEL_A, BESSEL_RF, LAT_0, LOCAL_SRID, LON_0, SHIFT_ARCSEC, SHIFT_M, SHIFT_PPM, WEB_RADIUS
from geosync.functions.shapes import Shapes

WGS84 = 4326


@dataclass(frozen=True)
class System:
    """``kind`` is lonlat, mercator (on the sphere), transverse or conic; angles in degrees, lengths in metres.

    ``shift`` are three metres, three arc seconds (position vector) and a scale in millionths, to WGS84.
    """

    kind: str
    ellipsoid: tuple[float, float] = (6378137.0, 298.257223563)
    lat_0: float = 0.0
    lon_0: float = 0.0
    scale: float = 1.0
    x_0: float = 0.0
    y_0: float = 0.0
    parallels: tuple[float, float] = (0.0, 0.0)
    shift: tuple[float, ...] = ()


# Ellipsoids (half axis, inverse flattening) and shifts of public registers.
GRS80 = (6378137.0, 298.257222101)
BESSEL = (BESSEL_A, BESSEL_RF)
KRASSOVSKY = (6378245.0, 298.3)
AIRY = (6377563.396, 299.3249646)
_PULKOVO = (23.92, -141.27, -80.9, 0.0, 0.35, 0.82, -0.12)
_OSGB = (446.448, -125.157, 542.06, 0.15, 0.247, 0.842, -20.489)
_DHDN = (598.1, 73.7, 418.2, 0.202, 0.045, -2.455, 6.7)
SYSTEMS = {
    WGS84: System("lonlat"), 4258: System("lonlat", GRS80), 4284: System("lonlat", KRASSOVSKY, shift=_PULKOVO), 4314: System("lonlat", BESSEL, shift=_DHDN),
    3857: System("mercator"), 900913: System("mercator"),
    LOCAL_SRID: System("transverse", BESSEL, LAT_0, LON_0, shift=(*SHIFT_M, *SHIFT_ARCSEC, SHIFT_PPM)),
    27700: System("transverse", AIRY, 49.0, -2.0, 0.9996012717, 400000.0, -100000.0, shift=_OSGB),
    2154: System("conic", GRS80, 46.5, 3.0, x_0=700000.0, y_0=6600000.0, parallels=(49.0, 44.0)),
    3034: System("conic", GRS80, 52.0, 10.0, x_0=4000000.0, y_0=2800000.0, parallels=(35.0, 65.0)),
}


def system(code: int) -> System | None:
    """The system of a code, zones of the common grids by their rule; None if it is not known."""
    if code in SYSTEMS:
        return SYSTEMS[code]
    family, zone = divmod(code, 100)
    if family in (326, 327, 258) and 1 <= zone <= 60:
        return System("transverse", GRS80 if family == 258 else (6378137.0, 298.257223563), 0.0, 6.0 * zone - 183, 0.9996, 500000.0, 1e7 if family == 327 else 0.0)
    if family == 284 and 2 <= zone <= 32:
        return System("transverse", KRASSOVSKY, 0.0, 6.0 * zone - 3, 1.0, zone * 1e6 + 500000.0, shift=_PULKOVO)
    if 31466 <= code <= 31469:
        zone = code - 31464
        return System("transverse", BESSEL, 0.0, 3.0 * zone, 1.0, zone * 1e6 + 500000.0, shift=_DHDN)
    return None


def _third(rf: float) -> float:
    return 1 / (2 * rf - 1)


def _conformal(lat: np.ndarray, e: float) -> np.ndarray:
    """Tangent of the conformal latitude, from the latitude in radians."""
    t = np.tan(lat)
    sigma = np.sinh(e * np.arctanh(e * t / np.sqrt(1 + t * t)))
    return t * np.sqrt(1 + sigma * sigma) - sigma * np.sqrt(1 + t * t)


def _latitude(tangent: np.ndarray, e: float) -> np.ndarray:
    """The latitude whose conformal tangent is given, by Newton's method."""
    t = tangent / (1 - e * e)
    for _ in range(8):
        root = np.sqrt(1 + t * t)
        sigma = np.sinh(e * np.arctanh(e * t / root))
        near = t * np.sqrt(1 + sigma * sigma) - sigma * root
        t = t + (tangent - near) / np.sqrt(1 + near * near) * (1 + (1 - e * e) * t * t) / ((1 - e * e) * root)
    return np.arctan(t)


def _arc(n: float) -> float:
    return (1 + n**2 / 4 + n**4 / 64 + n**6 / 256) / (1 + n)


def _forth(n: float) -> list[float]:
    return [
        n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3 + 41 / 180 * n**4 - 127 / 288 * n**5 + 7891 / 37800 * n**6,
        13 / 48 * n**2 - 3 / 5 * n**3 + 557 / 1440 * n**4 + 281 / 630 * n**5 - 1983433 / 1935360 * n**6,
        61 / 240 * n**3 - 103 / 140 * n**4 + 15061 / 26880 * n**5 + 167603 / 181440 * n**6,
        49561 / 161280 * n**4 - 179 / 168 * n**5 + 6601661 / 7257600 * n**6,
        34729 / 80640 * n**5 - 3418889 / 1995840 * n**6, 212378941 / 319334400 * n**6,
    ]


def _back(n: float) -> list[float]:
    return [
        n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3 - 1 / 360 * n**4 - 81 / 512 * n**5 + 96199 / 604800 * n**6,
        1 / 48 * n**2 + 1 / 15 * n**3 - 437 / 1440 * n**4 + 46 / 105 * n**5 - 1118711 / 3870720 * n**6,
        17 / 480 * n**3 - 37 / 840 * n**4 - 209 / 4480 * n**5 + 5569 / 90720 * n**6,
        4397 / 161280 * n**4 - 11 / 504 * n**5 - 830251 / 7257600 * n**6,
        4583 / 161280 * n**5 - 108847 / 3991680 * n**6, 20648693 / 638668800 * n**6,
    ]


def _transverse(s: System, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, rf = s.ellipsoid
    n, e = _third(rf), math.sqrt((2 - 1 / rf) / rf)
    radius = s.scale * a * _arc(n)
    chi = math.atan(float(_conformal(np.array(math.radians(s.lat_0)), e)))
    origin = chi + sum(c * math.sin(2 * k * chi) for k, c in enumerate(_forth(n), 1))
    north, east = (y - s.y_0) / radius + origin, (x - s.x_0) / radius
    xi, eta = north.copy(), east.copy()
    for k, c in enumerate(_back(n), 1):
        xi -= c * np.sin(2 * k * north) * np.cosh(2 * k * east)
        eta -= c * np.cos(2 * k * north) * np.sinh(2 * k * east)
    tangent = np.sin(xi) / np.sqrt(np.sinh(eta) ** 2 + np.cos(xi) ** 2)
    return math.radians(s.lon_0) + np.arctan2(np.sinh(eta), np.cos(xi)), _latitude(tangent, e)


def _conic(s: System, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, rf = s.ellipsoid
    e = math.sqrt((2 - 1 / rf) / rf)

    def width(lat: float) -> float:
        return math.cos(lat) / math.sqrt(1 - (e * math.sin(lat)) ** 2)

    def height(lat: float) -> float:
        # tangent of half the conformal colatitude
        t = float(_conformal(np.array(lat), e))
        return 1 / (t + math.sqrt(1 + t * t))

    p, q, o = (math.radians(v) for v in (*s.parallels, s.lat_0))
    cone = math.log(width(p) / width(q)) / math.log(height(p) / height(q)) if p != q else math.sin(p)
    reach = a * s.scale * width(p) / (cone * height(p) ** cone)
    rho_0 = reach * height(o) ** cone
    dx, dy = x - s.x_0, rho_0 - (y - s.y_0)
    rho = math.copysign(1, cone) * np.hypot(dx, dy)
    low = (rho / reach) ** (1 / cone)
    angle = np.arctan2(math.copysign(1, cone) * dx, math.copysign(1, cone) * dy)
    return math.radians(s.lon_0) + angle / cone, _latitude((1 / low - low) / 2, e)


def _shifted(s: System, lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, rf = s.ellipsoid
    e2 = (2 - 1 / rf) / rf
    normal = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    x, y, z = normal * np.cos(lat) * np.cos(lon), normal * np.cos(lat) * np.sin(lon), normal * (1 - e2) * np.sin(lat)
    tx, ty, tz = s.shift[:3]
    rx, ry, rz = (math.radians(v / 3600) for v in s.shift[3:6])
    m = 1 + s.shift[6] * 1e-6
    x, y, z = tx + m * (x - rz * y + ry * z), ty + m * (rz * x + y - rx * z), tz + m * (-ry * x + rx * y + z)
    a, rf = SYSTEMS[WGS84].ellipsoid
    e2 = (2 - 1 / rf) / rf
    across = np.hypot(x, y)
    out = np.arctan2(z, across * (1 - e2))
    for _ in range(6):
        out = np.arctan2(z + e2 * a / np.sqrt(1 - e2 * np.sin(out) ** 2) * np.sin(out), across)
    return np.arctan2(y, x), out


def lonlat(s: System, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Degrees in WGS84 of coordinates of a system."""
    if s.kind == "mercator":
        return np.degrees(x / WEB_RADIUS), np.degrees(2 * np.arctan(np.exp(y / WEB_RADIUS)) - np.pi / 2)
    if s.kind == "lonlat":
        if not s.shift:
            return x, y
        lon, lat = np.radians(x), np.radians(y)
    else:
        lon, lat = (_transverse if s.kind == "transverse" else _conic)(s, x, y)
    if s.shift:
        lon, lat = _shifted(s, lon, lat)
    return np.degrees((lon + np.pi) % (2 * np.pi) - np.pi), np.degrees(lat)


def _with_vertices(array: pa.Array, x: np.ndarray, y: np.ndarray) -> pa.Array:
    """The geometries of ``array`` with other vertices, in WGS84."""

    def field(structs: pa.Array, name: str) -> pa.Array:
        return structs.flatten()[structs.type.get_field_index(name)]

    def listed(like: pa.Array, values: pa.Array) -> pa.Array:
        counts = pc.fill_null(pc.list_value_length(like), 0).to_numpy(zero_copy_only=False)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)

    parts = field(array, "parts")
    flat = parts.flatten()
    rings = field(flat, "rings")
    vertices = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])
    whole = pa.StructArray.from_arrays([field(flat, "kind"), field(flat, "member"), listed(rings, listed(rings.flatten(), vertices))], names=["kind", "member", "rings"])
    srid = pa.array(np.full(len(array), WGS84, np.int32))
    return pa.StructArray.from_arrays([field(array, "kind"), listed(parts, whole), srid], names=["kind", "parts", "srid"], mask=array.is_null())


@F.arrow_udf(planar.GEOMETRY)
def _moved(geom: pa.Array, code: pa.Array, _: pa.Array) -> pa.Array:
    shapes = Shapes(geom)
    codes = pc.fill_null(code, WGS84).to_numpy(zero_copy_only=False)
    own = codes[shapes.geom[shapes.part[shapes.ring]]] if len(shapes.ring) else np.zeros(0, np.int64)
    x, y = shapes.x.copy(), shapes.y.copy()
    for each in np.unique(codes[np.asarray(geom.is_valid())]).tolist():
        found = system(int(each))
        if found is None:
            raise ValueError(f"no way to WGS84 from the system {each}")
        here = own == each
        x[here], y[here] = lonlat(found, x[here], y[here])
    return _with_vertices(geom, x, y)


def to_wgs84(geom: Column, code: Column) -> Column:
    """Geometry of a system named by its code, in WGS84; both must be columns of the frame. A code that is not known is an error."""
    return _moved(geom, code, geom["srid"])


def code_of(name: Column) -> Column:
    """The code in a system's name; WGS84's for none. Another name is an error, as its numbers would be read as degrees."""
    number = F.nullif(F.regexp_extract(name, r"(?i)EPSG[^0-9]*(?:[0-9.]*[:/])*([0-9]+)\D*$", 1), F.lit(""))
    unknown = F.raise_error(F.concat(F.lit("no way to WGS84 from "), name)).cast("int")
    return F.when(name.isNull() | name.rlike("(?i)CRS84|WGS ?84"), F.lit(WGS84)).when(number.isNotNull(), number.cast("int")).otherwise(unknown)
