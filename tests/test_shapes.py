"""Plane kernels against plain Python, without Spark."""

import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from geosync.functions import arrangement, planar, shapes

SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10)]


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def solid(*rings):
    return {"kind": "polygon", "member": 0, "rings": [[{"x": float(x), "y": float(y)} for x, y in [*r, r[0]]] for r in rings]}


def table(*geometries):
    rows = [None if g is None else {"kind": "multipolygon", "parts": g, "srid": 4326} for g in geometries]
    return pa.array(rows, planar._GEOMETRY)


def reasons(*geometries):
    return planar._reasons(table(*geometries))


def star(rng, cx, cy, n, size):
    turn = rng.random()
    return [(cx + math.cos(2 * math.pi * (j + turn) / n) * size * (0.4 + 0.6 * rng.random()), cy + math.sin(2 * math.pi * (j + turn) / n) * size * (0.4 + 0.6 * rng.random())) for j in range(n)]


def covered(x, y, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def test_validity_of_touching_rings():
    diamond = [(5, 0), (10, 5), (5, 10), (0, 5)]
    u_shape = [(0, 0), (10, 0), (10, 10), (7, 10), (7, 3), (3, 3), (3, 10), (0, 10)]
    cases = [
        ([solid(SQUARE)], None),
        ([solid(SQUARE), solid(diamond)], "parts overlap"),  # its corners on the square's edges
        ([solid(u_shape, [(1, 1), (2, 9), (8, 9), (9, 1)])], "hole outside its shell"),  # an edge leaves between two vertices inside
        ([solid(SQUARE, box(0, 2, 3, 5))], "hole outside its shell"),  # shares an edge
        ([solid(SQUARE, diamond)], "interior is cut"),
        ([solid(SQUARE, [(0, 5), (3, 3), (3, 7)])], None),  # touches in one point
        ([solid(SQUARE, [(0, 5), (5, 3), (10, 5), (5, 7)])], "interior is cut"),
        ([solid(SQUARE, [(0, 5), (2, 4), (4, 5), (2, 6)], [(4, 5), (6, 4), (8, 5), (6, 6)])], None),  # a chain of two
        ([solid(SQUARE, [(0, 5), (2, 4), (4, 5), (2, 6)], [(4, 5), (7, 4), (10, 5), (7, 6)])], "interior is cut"),
        ([solid(SQUARE), solid(box(10, 0, 20, 10))], "parts overlap"),  # share an edge
        ([solid(SQUARE), solid(box(10, 10, 20, 20))], None),  # share a corner
        ([solid(SQUARE, box(2, 2, 8, 8)), solid(box(3, 3, 7, 7))], None),
        ([solid(SQUARE, box(2, 2, 8, 8)), solid(box(1, 1, 9, 9))], "parts overlap"),
        ([solid(SQUARE, box(1, 1, 9, 9), box(2, 2, 3, 3))], "holes overlap"),
        ([solid(SQUARE, box(2, 2, 6, 6), box(4, 4, 8, 8))], "holes overlap"),
        ([solid(SQUARE, box(8, 8, 12, 12))], "hole outside its shell"),
        ([solid(SQUARE, box(20, 20, 22, 22))], "hole outside its shell"),
        ([solid([(0, 0), (10, 0), (10, 10), (15, 10), (10, 10), (0, 10)])], "self-intersection"),  # a spike
        ([solid([(0, 0), (10, 10), (10, 0), (0, 10)])], "self-intersection"),
        ([solid([(0, 0), (10, 0), (5, 5), (10, 10), (0, 10), (5, 5)])], "self-intersection"),  # meets itself in a point
        ([solid([(0, 0), (10, 0), (10, 0), (10, 10), (0, 10)])], None),  # a vertex twice
        ([solid(SQUARE), solid(SQUARE)], "parts overlap"),
        ([], "empty"),
        (None, "empty"),
    ]
    got = reasons(*[g for g, _ in cases])
    assert got == [want for _, want in cases]
    # alone and in a batch the same, and moved and turned
    for k, (g, want) in enumerate(cases):
        assert reasons(g) == [want], k
        if g:
            turned = [{**p, "rings": [[{"x": 3 - v["y"], "y": v["x"] + 100} for v in r] for r in p["rings"]]} for p in g]
            assert reasons(turned) == [want], k


def test_members_of_a_collection_are_judged_alone():
    one, other = solid(SQUARE), {**solid(box(5, 5, 15, 15)), "member": 1}
    assert reasons([one, other]) == [None]


MESSY = {
    "bow tie with a hole": [[(0, 0), (10, 10), (10, 0), (0, 10)], box(1, 4, 2, 6)],
    "spike": [[(0, 0), (10, 0), (10, 10), (15, 10), (10, 10), (0, 10)]],
    "inward spike": [[(0, 0), (10, 0), (10, 10), (5, 10), (5, 5), (5, 10), (0, 10)]],
    "hole across its shell": [SQUARE, box(8, 3, 14, 6)],
    "hole outside": [SQUARE, box(20, 3, 24, 6)],
    "hole sharing an edge": [SQUARE, box(0, 2, 3, 5)],
    "overlapping parts": [SQUARE, box(5, 5, 15, 15)],
    "parts sharing an edge": [SQUARE, box(10, 0, 20, 10)],
    "hole that cuts": [SQUARE, [(0, 5), (5, 3), (10, 5), (5, 7)]],
    "meets itself": [[(0, 0), (10, 0), (5, 5), (10, 10), (0, 10), (5, 5)]],
    "nested holes": [SQUARE, box(1, 1, 9, 9), box(3, 3, 6, 6)],
}


@pytest.mark.parametrize("name", sorted(MESSY))
def test_rebuilt_is_valid(name):
    rings = MESSY[name]
    made = arrangement.rebuilt([[(float(x), float(y)) for x, y in r] for r in rings])
    assert reasons([solid(*[r[:-1] for r in p]) for p in made]) == [None]
    for x in np.arange(-1.03, 26, 0.77):
        for y in np.arange(-1.07, 16, 0.83):
            assert covered(x, y, rings) == sum(covered(x, y, [r[:-1] for r in p]) for p in made), (x, y)


@pytest.mark.parametrize("seed", range(8))
def test_rebuilt_of_random_rings(seed):
    rng = random.Random(seed)
    rings = [[(rng.random() * 10, rng.random() * 10) for _ in range(rng.randint(3, 25))] for _ in range(rng.randint(1, 4))]
    if seed % 2:  # on a lattice edges run along each other and meet in corners
        rings = [[(round(x), round(y)) for x, y in r] for r in rings]
    made = arrangement.rebuilt([[(float(x), float(y)) for x, y in r] for r in rings])
    assert reasons([solid(*[r[:-1] for r in p]) for p in made]) == [None]
    for _ in range(400):
        x, y = rng.random() * 10 + 1e-5, rng.random() * 10 + 1e-5
        assert covered(x, y, rings) == sum(covered(x, y, [r[:-1] for r in p]) for p in made)


def test_nothing_left():
    assert arrangement.rebuilt([[(0.0, 0.0), (4.0, 0.0), (2.0, 0.0)]]) is None and arrangement.rebuilt([]) is None


def wheel(n, cx, cy, size, wave=0.3):
    a = np.arange(n) * 2 * math.pi / n
    r = size * (1 + wave * np.sin(a * 7))
    return list(zip((cx + r * np.cos(a)).tolist(), (cy + r * np.sin(a)).tolist()))


def test_large_borders_take_little_time():
    one, other = table([solid(wheel(10_000, 37.5, 55.5, 0.1))]), table([solid(wheel(10_000, 37.55, 55.5, 0.1))])
    start = time.perf_counter()
    a, b, k = shapes.Borders(shapes.Shapes(one)), shapes.Borders(shapes.Shapes(other)), np.zeros(1, np.int64)
    both, whole = shapes.overlap(a, b, k, k)[0], shapes.overlap(a, a, k, k)[0]
    assert shapes.meets(shapes.Prepared(shapes.Shapes(one)), shapes.Prepared(shapes.Shapes(other)), k, k).all()
    assert planar._reasons(one) == [None]
    assert time.perf_counter() - start < 4
    assert 0 < both < whole


def test_overlap_by_sampling():
    rng = random.Random(5)
    for _ in range(6):
        one, other = [star(rng, 37.5, 55.5, 9, 0.1), star(rng, 37.5, 55.5, 5, 0.02)], [star(rng, 37.53, 55.52, 12, 0.1)]
        k = np.zeros(1, np.int64)
        got = shapes.overlap(shapes.Borders(shapes.Shapes(table([solid(*one)]))), shapes.Borders(shapes.Shapes(table([solid(*other)]))), k, k)[0]
        if reasons([solid(*one)]) != [None]:
            continue
        # a lattice of equal areas
        y = np.linspace(shapes.authalic(np.array(55.3)), shapes.authalic(np.array(55.7)), 241)
        xs, cell = np.linspace(37.3, 37.8, 241), np.radians(0.5) / 240 * 6378137.0 * (y[1] - y[0])
        lat = np.interp(y, shapes.authalic(np.linspace(55.2, 55.8, 4001)), np.linspace(55.2, 55.8, 4001))
        count = sum(covered(x + 1e-9, v, one) and covered(x + 1e-9, v, other) for x in xs for v in lat)
        assert got == pytest.approx(count * cell, rel=0.05)


def plain_meets(a, b):
    """By all pairs of edges, and a vertex of one in the other."""

    def edges(g):
        for p in g:
            for r in p["rings"]:
                v = [(q["x"], q["y"]) for q in r]
                yield from (zip(v, v[1:]) if len(v) > 1 else [(v[0], v[0])])

    def side(p, q, r):
        return np.sign((q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0]))

    def met(e, f):
        for k in (0, 1):
            if max(e[0][k], e[1][k]) < min(f[0][k], f[1][k]) or max(f[0][k], f[1][k]) < min(e[0][k], e[1][k]):
                return False
        return side(*e, f[0]) * side(*e, f[1]) <= 0 and side(*f, e[0]) * side(*f, e[1]) <= 0

    def holds(g, p):
        x, y = p["rings"][0][0]["x"], p["rings"][0][0]["y"]
        return any(q["kind"] == "polygon" and covered(x, y, [[(v["x"], v["y"]) for v in r[:-1]] for r in q["rings"]]) for q in g)

    return any(met(e, f) for e in edges(a) for f in edges(b)) or any(holds(b, p) for p in a) or any(holds(a, p) for p in b)


def test_meets_equals_brute_force():
    rng = random.Random(11)

    def some(scale):
        kind = rng.choice(("polygon", "linestring", "point"))
        cx, cy = rng.random() * 10, rng.random() * 10
        at = lambda: (cx + rng.random() * scale, cy + rng.random() * scale)
        if rng.random() < 0.4:
            cx, cy, at = round(cx), round(cy), lambda: (cx + rng.randint(0, 2), cy + rng.randint(0, 2))
        if kind == "polygon":
            return solid(*([star(rng, cx, cy, rng.randint(3, 30), scale)] + ([star(rng, cx, cy, 4, scale * 0.2)] if rng.random() < 0.3 else [])))
        n = 1 if kind == "point" else rng.randint(2, 6)
        return {"kind": kind, "member": 0, "rings": [[dict(zip("xy", map(float, at()))) for _ in range(n)]]}

    left = [[some(1.5) for _ in range(rng.randint(1, 3))] for _ in range(60)]
    right = [[some(3) for _ in range(rng.randint(1, 3))] for _ in range(40)]
    a, b = shapes.Prepared(shapes.Shapes(table(*left))), shapes.Prepared(shapes.Shapes(table(*right)))
    ia, ib = (v.ravel() for v in np.meshgrid(np.arange(60), np.arange(40)))
    got = shapes.meets(a, b, ia, ib)
    assert got.tolist() == [bool(plain_meets(left[i], right[j])) for i, j in zip(ia, ib)]
    assert got.any() and not got.all()
