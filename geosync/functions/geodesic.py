"""Lengths of shortest lines on the ellipsoid, by iteration on the auxiliary sphere, for whole arrays."""

from __future__ import annotations

import numpy as np

from geosync.functions.geom import WGS84_A, WGS84_F

#: Rounds of the iteration; it settles in a few unless the ends are nearly opposite.
ROUNDS = 60
SETTLED = 1e-13
_B = WGS84_A * (1 - WGS84_F)
_GOLDEN = (5**0.5 - 1) / 2


def _settled(lat1: np.ndarray, lat2: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances, and where the iteration settled. ``turn`` is the difference of longitudes, all in radians."""
    f = WGS84_F
    u1, u2 = np.arctan((1 - f) * np.tan(lat1)), np.arctan((1 - f) * np.tan(lat2))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = turn.copy()
    settled = np.zeros(len(turn), bool)
    for _ in range(ROUNDS):
        sl, cl = np.sin(lam), np.cos(lam)
        # the second term without the loss of digits between close ends
        across, along = c2 * sl, np.sin(u2 - u1) + 2 * s1 * c2 * np.sin(lam / 2) ** 2
        sin_sigma, cos_sigma = np.hypot(across, along), s1 * s2 + c1 * c2 * cl
        sigma = np.arctan2(sin_sigma, cos_sigma)
        sin_alpha = np.divide(c1 * c2 * sl, sin_sigma, out=np.zeros_like(sl), where=sin_sigma > 0)
        cos2_alpha = np.maximum(1 - sin_alpha**2, 0)
        middle = cos_sigma - np.divide(2 * s1 * s2, cos2_alpha, out=np.zeros_like(sl), where=cos2_alpha > 1e-14)
        middle = np.where(cos2_alpha > 1e-14, middle, 0.0)
        c = f / 16 * cos2_alpha * (4 + f * (4 - 3 * cos2_alpha))
        new = turn + (1 - c) * f * sin_alpha * (sigma + c * sin_sigma * (middle + c * cos_sigma * (2 * middle**2 - 1)))
        settled = (np.abs(new - lam) < SETTLED) & (np.abs(new) <= np.pi)
        lam = new
        if settled.all():
            break
    k = (np.sqrt(1 + cos2_alpha * (WGS84_A**2 - _B**2) / _B**2) - 1) / (np.sqrt(1 + cos2_alpha * (WGS84_A**2 - _B**2) / _B**2) + 1)
    scale, bend = (1 + k * k / 4) / (1 - k), k * (1 - 3 * k * k / 8)
    inner = cos_sigma * (2 * middle**2 - 1) - bend / 6 * middle * (4 * sin_sigma**2 - 3) * (4 * middle**2 - 3)
    delta = bend * sin_sigma * (middle + bend / 4 * inner)
    return _B * scale * (sigma - delta), settled


def distances(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """Metres between positions in degrees, the short way round; NaN where one is missing or beyond a pole.

    Between nearly opposite ends, where the iteration does not settle, the line is cut at the meridian half way: the
    point of it with the least sum of both distances is on the line.
    """
    p1, p2 = np.radians(np.asarray(lat1, float)), np.radians(np.asarray(lat2, float))
    turn = np.radians((np.asarray(lon2, float) - np.asarray(lon1, float) + 180) % 360 - 180)
    known = (np.abs(p1) <= np.pi / 2 + 1e-12) & (np.abs(p2) <= np.pi / 2 + 1e-12) & np.isfinite(turn)
    out = np.full(len(turn), np.nan)
    length, settled = _settled(p1[known], p2[known], turn[known])
    hard = np.flatnonzero(known)[~settled]
    out[known] = length
    if len(hard):
        a, b, half = p1[hard], p2[hard], turn[hard] / 2

        def both(lat: np.ndarray) -> np.ndarray:
            return _settled(a, lat, half)[0] + _settled(lat, b, half)[0]

        sides = []
        for low, high in ((0.0, np.pi / 2), (-np.pi / 2, 0.0)):
            lo, hi = np.full(len(hard), low), np.full(len(hard), high)
            for _ in range(80):
                x, y = hi - _GOLDEN * (hi - lo), lo + _GOLDEN * (hi - lo)
                left = both(x) < both(y)
                lo, hi = np.where(left, lo, x), np.where(left, y, hi)
            sides.append(both((lo + hi) / 2))
        out[hard] = np.minimum(*sides)
    return out
