"""Shortest lines against quadrature of the exact integrals, and against published distances."""

import math
import random

import numpy as np
import pytest

from geosync.functions import geodesic

A, F = 6378137.0, 1 / 298.257223563
NODES, WEIGHTS = np.polynomial.legendre.leggauss(40)


def quadrature(function, a, b):
    x = (b - a) / 2 * NODES + (a + b) / 2
    return (b - a) / 2 * float((WEIGHTS * function(x)).sum())


def shooting(lat1, lat2, turn):
    """Distance by bisection over the azimuth at the first end, and Gauss quadrature along the line (degrees, 0 < turn < 180)."""
    b = A * (1 - F)
    ep2 = (A * A - b * b) / (b * b)
    beta1, beta2 = (math.atan((1 - F) * math.tan(math.radians(v))) for v in (lat1, lat2))
    if abs(beta1) < abs(beta2):
        beta1, beta2 = beta2, beta1
    if beta1 > 0:
        beta1, beta2 = -beta1, -beta2

    def end(alpha1):
        sin0 = math.sin(alpha1) * math.cos(beta1)
        cos0 = math.hypot(math.cos(alpha1), math.sin(alpha1) * math.sin(beta1))
        sigma1 = math.atan2(math.sin(beta1), math.cos(alpha1) * math.cos(beta1))
        omega1 = math.atan2(sin0 * math.sin(sigma1), math.cos(sigma1))
        square = max(math.cos(alpha1) ** 2 * math.cos(beta1) ** 2 + math.cos(beta2) ** 2 - math.cos(beta1) ** 2, 0)
        cos2 = math.sqrt(square) / math.cos(beta2)
        sigma2 = math.atan2(math.sin(beta2), cos2 * math.cos(beta2))
        omega2 = math.atan2(sin0 * math.sin(sigma2), math.cos(sigma2))
        k2 = ep2 * cos0 * cos0
        lag = quadrature(lambda s: (2 - F) / (1 + (1 - F) * np.sqrt(1 + k2 * np.sin(s) ** 2)), sigma1, sigma2)
        return omega2 - omega1 - F * sin0 * lag, b * quadrature(lambda s: np.sqrt(1 + k2 * np.sin(s) ** 2), sigma1, sigma2)

    low, high = 0.0, math.pi
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if end(middle)[0] < math.radians(turn) else (low, middle)
    return end((low + high) / 2)[1]


def test_published_distances():
    cases = [
        (174.81, -41.32, -5.50, 40.96, 19959679.267, 0.02), (-73.8, 40.6, 2.55, 49.01666667, 5853226.26, 1.0),
        (0, 0, 0, 90, 10001965.729, 0.001), (10, 0, 100, 0, A * math.pi / 2, 1e-6), (0, 89, 180, 89, 2 * 111693.865, 0.01), (5, 90, 77, 90, 0, 1e-6),
    ]
    for lon1, lat1, lon2, lat2, want, allowed in cases:
        got = geodesic.distances(*(np.array([float(v)]) for v in (lon1, lat1, lon2, lat2)))[0]
        assert got == pytest.approx(want, abs=allowed)


def test_against_quadrature():
    rng = random.Random(6)
    rows = [(rng.uniform(-89, 89), rng.uniform(-89, 89), rng.uniform(0.01, 170)) for _ in range(150)]
    rows += [(rng.uniform(-80, 80), 0, rng.uniform(1e-4, 0.2)) for _ in range(50)]
    rows = [(a, a + rng.uniform(-0.1, 0.1) if b == 0 else b, t) for a, b, t in rows]
    rows += [(10.0, -10.02, 179.9), (0.3, -0.2, 179.6), (45.0, -44.9, 179.5)]
    lat1, lat2, turn = map(np.array, zip(*rows))
    got = geodesic.distances(np.full(len(rows), 170.0), lat1, 170 + turn, lat2)
    want = [shooting(*r) for r in rows]
    assert got == pytest.approx(want, rel=1e-9)


def test_close_ends_and_missing():
    x = np.array([37.5, 37.5, np.nan, 37.5, 179.9999])
    y = np.array([55.5, 55.5, 1.0, 91.0, 10.0])
    got = geodesic.distances(x, y, np.array([37.5, 37.5 + 1e-6, 1.0, 2.0, -179.9999]), np.array([55.5, 55.5, 1.0, 2.0, 10.0]))
    assert got[0] == 0 and got[1] == pytest.approx(0.063197, rel=1e-4) and np.isnan(got[2:4]).all() and got[4] == pytest.approx(21.927, rel=1e-3)
