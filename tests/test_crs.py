"""Projected systems against forward formulas of other books, and published control points."""

import math
import random

import numpy as np
import pytest

from geosync.functions import crs


def forward_transverse(s, lon, lat):
    """Redfearn's series in the longitude, for positions near the central meridian."""
    a, rf = s.ellipsoid
    f = 1 / rf
    e2 = f * (2 - f)
    phi, dl = math.radians(lat), math.radians(lon - s.lon_0)

    def arc(v):
        nodes, weights = np.polynomial.legendre.leggauss(40)
        at = v / 2 * nodes + v / 2
        return v / 2 * float((weights * a * (1 - e2) / (1 - e2 * np.sin(at) ** 2) ** 1.5).sum())

    nu, rho = a / math.sqrt(1 - e2 * math.sin(phi) ** 2), a * (1 - e2) / (1 - e2 * math.sin(phi) ** 2) ** 1.5
    psi, t, c, si = nu / rho, math.tan(phi), math.cos(phi), math.sin(phi)
    w = dl
    east = nu * w * c * (1 + (w * c) ** 2 / 6 * (psi - t**2) + (w * c) ** 4 / 120 * (4 * psi**3 * (1 - 6 * t**2) + psi**2 * (1 + 8 * t**2) - 2 * psi * t**2 + t**4) + (w * c) ** 6 / 5040 * (61 - 479 * t**2 + 179 * t**4 - t**6))
    north = arc(phi) - arc(math.radians(s.lat_0)) + nu * si * c * w**2 / 2 + nu * si * c**3 * w**4 / 24 * (4 * psi**2 + psi - t**2)
    north += nu * si * c**5 * w**6 / 720 * (8 * psi**4 * (11 - 24 * t**2) - 28 * psi**3 * (1 - 6 * t**2) + psi**2 * (1 - 32 * t**2) - 2 * psi * t**2 + t**4)
    return s.x_0 + s.scale * east, s.y_0 + s.scale * north


def forward_conic(s, lon, lat):
    a, rf = s.ellipsoid
    e = math.sqrt((2 - 1 / rf) / rf)
    m = lambda v: math.cos(v) / math.sqrt(1 - (e * math.sin(v)) ** 2)
    t = lambda v: math.tan(math.pi / 4 - v / 2) / ((1 - e * math.sin(v)) / (1 + e * math.sin(v))) ** (e / 2)
    p, q, o, phi = (math.radians(v) for v in (*s.parallels, s.lat_0, lat))
    n = (math.log(m(p)) - math.log(m(q))) / (math.log(t(p)) - math.log(t(q)))
    big = m(p) / (n * t(p) ** n)
    r, r0, theta = a * big * t(phi) ** n, a * big * t(o) ** n, n * math.radians(lon - s.lon_0)
    return s.x_0 + r * math.sin(theta), s.y_0 + r0 - r * math.cos(theta)


def unshifted(s, lon, lat):
    """The position on the system's own ellipsoid of one in WGS84, by turning the shift round step by step."""
    x, y = lon, lat
    for _ in range(30):
        u, v = crs._shifted(s, np.radians(np.array([x])), np.radians(np.array([y])))
        x, y = x + lon - float(np.degrees(u[0])), y + lat - float(np.degrees(v[0]))
    return x, y


@pytest.mark.parametrize("code", [32637, 32737, 25832, 28407, 27700, 31467, 980077, 2154, 3034, 4284])
def test_back_from_forward(code):
    s = crs.system(code)
    rng = random.Random(code)
    for _ in range(40):
        south = -1 if code == 32737 else 1
        lon, lat = s.lon_0 + rng.uniform(-2.9, 2.9), south * rng.uniform(36, 64)
        own = unshifted(s, lon, lat) if s.shift else (lon, lat)
        x, y = {"transverse": forward_transverse, "conic": forward_conic, "lonlat": lambda _, *v: v}[s.kind](s, *own)
        u, v = crs.lonlat(s, np.array([x]), np.array([y]))
        assert (u[0], v[0]) == pytest.approx((lon, lat), abs=2e-8)


def test_published_points():
    # an Ordnance Survey example on the system's own ellipsoid, a position in zone 38, the origin of a conic
    own = crs.System(**{**crs.SYSTEMS[27700].__dict__, "shift": ()})
    lon, lat = crs.lonlat(own, np.array([651409.903, 577274.99]), np.array([313177.270, 69740.50]))
    assert lon == pytest.approx([1 + 43 / 60 + 4.5177 / 3600, 0.5], abs=2e-7) and lat == pytest.approx([52 + 39 / 60 + 27.2531 / 3600, 50.5], abs=2e-7)
    lon, lat = crs.lonlat(crs.system(32638), np.array([444140.54]), np.array([3684706.36]))
    assert (lon[0], lat[0]) == pytest.approx((44.4, 33.3), abs=1e-6)
    lon, lat = crs.lonlat(crs.system(2154), np.array([700000.0]), np.array([6600000.0]))
    assert (lon[0], lat[0]) == pytest.approx((3.0, 46.5), abs=1e-9)
    assert crs.system(99999) is None and crs.system(32661) is None
