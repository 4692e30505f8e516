"""Plane geometry over whole Arrow batches: vertices as flat arrays, edges met through slabs, in numpy.

A slab index cuts the extent of a group of edges into slabs of one height and lists for each slab the edges that reach
it. It is built once for a polygon and serves all its candidates: a point asks one slab, an edge those it reaches.
Edges whose ranges miss are never paired, and the number of slabs is bounded so that the lists stay in proportion to
the edges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from geosync.functions.geom import SAME_VERTEX, WGS84_A, WGS84_F

SOLID, LINE, DOT = 0, 1, 2
KINDS = ("polygon", "linestring", "point")
#: Pairs of edges that are looked at in one step.
STEP = 1 << 20
#: The same of boxes, of which all may meet, and halvings of the largest box's size below which all are of one size.
BOX_STEP, SIZES = 1 << 18, 40


def spread(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of integers: the range of each integer, and the integers, one range after the other."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner] + starts[owner]


def steps(counts: np.ndarray, most: int = STEP) -> Iterator[slice]:
    """Slices of ranges that hold ``most`` integers together, or one range that holds more."""
    ends = np.cumsum(counts)
    lo = 0
    while lo < len(counts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield slice(lo, hi)
        lo = hi


def cross(ax, ay, bx, by, cx, cy):
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def _opened(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(lists)), counts), lists.flatten()


def _field(structs: pa.Array, name: str) -> pa.Array:
    return structs.flatten()[structs.type.get_field_index(name)]


@dataclass
class Edges:
    x1: np.ndarray
    y1: np.ndarray
    x2: np.ndarray
    y2: np.ndarray
    ring: np.ndarray

    def take(self, at) -> Edges:
        return Edges(self.x1[at], self.y1[at], self.x2[at], self.y2[at], self.ring[at])

    def extent(self, along_x: bool | np.ndarray = False) -> tuple[np.ndarray, np.ndarray]:
        u1, u2 = np.where(along_x, self.x1, self.y1), np.where(along_x, self.x2, self.y2)
        return np.minimum(u1, u2), np.maximum(u1, u2)

    def sides(self, i: np.ndarray, other: Edges, j: np.ndarray) -> tuple[np.ndarray, ...]:
        """Whether boxes meet, and on which side of each edge the ends of the other lie."""
        ex1, ey1, ex2, ey2 = self.x1[i], self.y1[i], self.x2[i], self.y2[i]
        fx1, fy1, fx2, fy2 = other.x1[j], other.y1[j], other.x2[j], other.y2[j]
        boxes = (np.minimum(ex1, ex2) <= np.maximum(fx1, fx2)) & (np.minimum(fx1, fx2) <= np.maximum(ex1, ex2))
        boxes &= (np.minimum(ey1, ey2) <= np.maximum(fy1, fy2)) & (np.minimum(fy1, fy2) <= np.maximum(ey1, ey2))
        a, b = np.sign(cross(ex1, ey1, ex2, ey2, fx1, fy1)), np.sign(cross(ex1, ey1, ex2, ey2, fx2, fy2))
        c, d = np.sign(cross(fx1, fy1, fx2, fy2, ex1, ey1)), np.sign(cross(fx1, fy1, fx2, fy2, ex2, ey2))
        return boxes & (a * b <= 0) & (c * d <= 0), a, b, c, d


class Slabs:
    """Ranges of values by group, found through slabs."""

    def __init__(self, low: np.ndarray, high: np.ndarray, group: np.ndarray, groups: int, per: int = 2):
        self.count = np.bincount(group, minlength=groups)
        self.start, self.end = np.full(groups, np.inf), np.full(groups, -np.inf)
        np.minimum.at(self.start, group, low)
        np.maximum.at(self.end, group, high)
        extent = np.where(self.count > 0, self.end - self.start, 0.0)
        reach = np.bincount(group, weights=high - low, minlength=groups)
        bound = np.divide(4.0 * self.count * extent, reach, out=np.full(groups, 1.0), where=reach > 0)
        self.number = np.maximum(1, np.minimum(self.count // per, bound)).astype(np.int64)
        self.height = np.where(extent > 0, extent / self.number, 1.0)
        self.base = np.concatenate([[0], np.cumsum(self.number)])
        self.low, self.high, self.group = low, high, group
        first, last = self.slab(group, low), self.slab(group, high)
        owner, slabs = spread(first, last - first + 1)
        order = np.argsort(slabs, kind="stable")
        self.members, self.where = owner[order], slabs[order]
        self.offsets = np.searchsorted(self.where, np.arange(self.base[-1] + 1))

    def slab(self, group: np.ndarray, value: np.ndarray) -> np.ndarray:
        place = np.floor((value - self.start[group]) / self.height[group])
        return self.base[group] + np.clip(place, 0, self.number[group] - 1).astype(np.int64)

    def candidates(self, group: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, member) whose ranges meet, each once, in steps."""
        asked = np.flatnonzero((self.count[group] > 0) & (high >= self.start[group]) & (low <= self.end[group]))
        group, low, high = group[asked], low[asked], high[asked]
        first, last = self.slab(group, low), self.slab(group, high)
        for part in steps(last - first + 1):
            owner, slabs = spread(first[part], (last - first + 1)[part])
            counts = self.offsets[slabs + 1] - self.offsets[slabs]
            for some in steps(counts):
                entry, at = spread(self.offsets[slabs[some]], counts[some])
                q, m = owner[some][entry] + part.start, self.members[at]
                # met in several slabs, a pair counts in the one where the later range begins
                home = slabs[some][entry] == self.slab(group[q], np.maximum(low[q], self.low[m]))
                near = home & (low[q] <= self.high[m]) & (self.low[m] <= high[q])
                yield asked[q[near]], m[near]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of members of one group whose ranges meet, each once, in steps."""
        ends = self.offsets[self.where + 1]
        place = np.arange(len(self.members))
        counts = ends - place - 1
        for part in steps(counts):
            entry, at = spread(place[part] + 1, counts[part])
            i, j = self.members[part][entry], self.members[at]
            home = self.where[part][entry] == self.slab(self.group[i], np.maximum(self.low[i], self.low[j]))
            near = home & (self.low[i] <= self.high[j]) & (self.low[j] <= self.high[i])
            yield np.minimum(i[near], j[near]), np.maximum(i[near], j[near])


class Shapes:
    """Geometries of an Arrow array: parts, rings and vertices in flat arrays, each with its owner."""

    def __init__(self, array: pa.Array):
        if isinstance(array, pa.ChunkedArray):
            array = array.combine_chunks()
        self.n = len(array)
        self.geom, parts = _opened(_field(array, "parts"))
        kind = _field(parts, "kind")
        self.kind = pc.fill_null(pc.index_in(kind, value_set=pa.array(KINDS, kind.type)), DOT).to_numpy(zero_copy_only=False)
        self.member = pc.fill_null(_field(parts, "member"), 0).to_numpy(zero_copy_only=False)
        self.part, rings = _opened(_field(parts, "rings"))
        self.place = np.arange(len(self.part)) - np.searchsorted(self.part, self.part)
        self.ring, vertices = _opened(rings)
        self.x, self.y = (_field(vertices, c).to_numpy(zero_copy_only=False) for c in ("x", "y"))

    def edges(self) -> Edges:
        """All edges, and points as edges without a length, by geometry."""
        first = np.flatnonzero(self.ring[1:] == self.ring[:-1])
        lone = np.flatnonzero(self.kind[self.part[self.ring]] == DOT)
        at = np.concatenate([first, lone])
        to = np.concatenate([first + 1, lone])
        order = np.argsort(at, kind="stable")
        at, to = at[order], to[order]
        return Edges(self.x[at], self.y[at], self.x[to], self.y[to], self.ring[at])

    def first_vertices(self) -> tuple[np.ndarray, np.ndarray]:
        """The first vertex of each part that has one, and its geometry."""
        part = self.part[self.ring]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else part
        return first, self.geom[part[first]]

    def fills_box(self) -> np.ndarray:
        """Geometries that are the whole of their box: one point, or one polygon with one ring around a box and no other part."""
        rings = np.bincount(self.geom[self.part], minlength=self.n)
        lone = (np.bincount(self.geom, minlength=self.n) == 1) & (rings == 1)
        owner = self.geom[self.part]
        size = np.bincount(self.ring, minlength=len(self.part))
        start = np.cumsum(size) - size
        kind = self.kind[self.part]
        out = np.zeros(self.n, bool)
        out[owner[lone[owner] & (kind == DOT) & (size == 1)]] = True
        ring = np.flatnonzero(lone[owner] & (kind == SOLID) & (size == 5))
        x, y = (v[start[ring][:, None] + np.arange(5)] for v in (self.x, self.y))
        dx, dy = x[:, 1:] != x[:, :-1], y[:, 1:] != y[:, :-1]
        # each side along one axis, in turn, and back to the first corner
        square = (dx != dy).all(1) & (dx[:, 1:] != dx[:, :-1]).all(1) & (x[:, 0] == x[:, 4]) & (y[:, 0] == y[:, 4])
        out[owner[ring[square]]] = True
        return out


class Prepared:
    """Geometries with their edges and an index over them, made once for all candidates."""

    def __init__(self, shapes: Shapes):
        self.shapes, self.edges = shapes, shapes.edges()
        self.part = shapes.part[self.edges.ring]
        self.group = shapes.geom[self.part]
        self.solid = shapes.kind[self.part] == SOLID
        self.offsets = np.searchsorted(self.group, np.arange(shapes.n + 1))
        self._index: Slabs | None = None

    @property
    def index(self) -> Slabs:
        if self._index is None:
            self._index = Slabs(*self.edges.extent(), self.group, self.shapes.n)
        return self._index

    def covers(self, group: np.ndarray, x: np.ndarray, y: np.ndarray, strict: bool = False) -> np.ndarray:
        """Whether positions lie in a polygon part of the geometries named, on its border too unless ``strict``."""
        e, parts = self.edges, len(self.shapes.geom) + 1
        odd, border = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for q, m in self.index.candidates(group, y, y):
            solid = self.solid[m]
            q, m = q[solid], m[solid]
            x1, y1, x2, y2, px, py = e.x1[m], e.y1[m], e.x2[m], e.y2[m], x[q], y[q]
            spans = (y1 > py) != (y2 > py)
            rise = np.divide(py - y1, y2 - y1, out=np.zeros(len(q)), where=y1 != y2)
            key = q * parts + self.part[m]
            odd.append(key[spans & (px < (x2 - x1) * rise + x1)])
            on = (cross(x1, y1, x2, y2, px, py) == 0) & (np.minimum(x1, x2) <= px) & (px <= np.maximum(x1, x2))
            border.append(key[on])
        inside, times = np.unique(np.concatenate(odd), return_counts=True)
        inside, border = inside[times % 2 == 1], np.unique(np.concatenate(border))
        held = np.setdiff1d(inside, border) if strict else np.union1d(inside, border)
        out = np.zeros(len(group), bool)
        out[held // parts] = True
        return out


def meets(a: Prepared, b: Prepared, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """Whether geometry ``ia[k]`` of ``a`` and ``ib[k]`` of ``b`` share a point, for each k."""
    hit = np.zeros(len(ia), bool)
    first, owner = a.shapes.first_vertices()
    starts = np.searchsorted(owner, np.arange(a.shapes.n + 1))
    pair, at = spread(starts[ia], (starts[1:] - starts[:-1])[ia])
    hit[pair[b.covers(ib[pair], a.shapes.x[first[at]], a.shapes.y[first[at]])]] = True

    todo = np.flatnonzero(~hit)
    counts = (a.offsets[1:] - a.offsets[:-1])[ia[todo]]
    low, high = a.edges.extent()
    for part in steps(counts):
        pair, e = spread(a.offsets[ia[todo[part]]], counts[part])
        pair = todo[part][pair]
        for q, m in b.index.candidates(ib[pair], low[e], high[e]):
            found = a.edges.sides(e[q], b.edges, m)[0]
            hit[pair[q[found]]] = True

    if a.solid.any():
        todo = np.flatnonzero(~hit)
        first, owner = b.shapes.first_vertices()
        starts = np.searchsorted(owner, np.arange(b.shapes.n + 1))
        pair, at = spread(starts[ib[todo]], (starts[1:] - starts[:-1])[ib[todo]])
        hit[todo[pair[a.covers(ia[todo[pair]], b.shapes.x[first[at]], b.shapes.y[first[at]])]]] = True
    return hit


# --- overlap -----------------------------------------------------------------------------------

_E2 = WGS84_F * (2 - WGS84_F)
_E = math.sqrt(_E2)


def authalic(lat: np.ndarray) -> np.ndarray:
    """Height of a latitude in the cylindrical plane that keeps areas, in metres."""
    s = np.sin(np.radians(lat))
    return WGS84_A / 2 * (1 - _E2) * (s / (1 - _E2 * s * s) - 1 / (2 * _E) * np.log((1 - _E * s) / (1 + _E * s)))


class Borders:
    """Polygon edges in the plane that keeps areas, from left to right, relative to each geometry's first vertex.

    ``sign`` is 1 for an upper border and -1 for a lower one, so that the strips below the edges sum up to the polygon.
    """

    def __init__(self, shapes: Shapes):
        first, owner = shapes.first_vertices()
        one, at = np.unique(owner, return_index=True)
        x, y = np.radians(shapes.x) * WGS84_A, authalic(shapes.y)
        self.origin = np.zeros((shapes.n, 2))
        self.origin[one] = np.stack([x[first[at]], y[first[at]]], axis=1)
        geom = shapes.geom[shapes.part[shapes.ring]]
        x, y = x - self.origin[geom, 0], y - self.origin[geom, 1]
        start = np.flatnonzero((shapes.ring[1:] == shapes.ring[:-1]) & (shapes.kind[shapes.part[shapes.ring[1:]]] == SOLID))
        ring = shapes.ring[start]
        x1, y1, x2, y2 = x[start], y[start], x[start + 1], y[start + 1]
        twice = np.bincount(ring, weights=x1 * y2 - x2 * y1, minlength=len(shapes.part))
        turn = np.sign(twice) * np.where(shapes.place == 0, 1, -1)
        keep = x1 != x2
        x1, y1, x2, y2, ring = x1[keep], y1[keep], x2[keep], y2[keep], ring[keep]
        right = x1 < x2
        self.xa, self.xb, self.ya = np.minimum(x1, x2), np.maximum(x1, x2), np.where(right, y1, y2)
        self.slope = (y2 - y1) / (x2 - x1)
        self.sign = turn[ring] * np.where(right, -1, 1)
        self.group = shapes.geom[shapes.part[ring]]
        self.offsets = np.searchsorted(self.group, np.arange(shapes.n + 1))
        self.n = shapes.n
        self._index: Slabs | None = None

    @property
    def index(self) -> Slabs:
        if self._index is None:
            self._index = Slabs(self.xa, self.xb, self.group, self.n)
        return self._index


def overlap(a: Borders, b: Borders, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """Area in square metres that the polygons of ``ia[k]`` and ``ib[k]`` share, for each k.

    For each pair of borders over one range of x the lower of the two lines is integrated, split where they cross.
    """
    out = np.zeros(len(ia))
    counts = (a.offsets[1:] - a.offsets[:-1])[ia]
    for part in steps(counts):
        pair, e = spread(a.offsets[ia[part]], counts[part])
        pair = pair + part.start
        shift = a.origin[ia[pair]] - b.origin[ib[pair]]
        xa, xb, ya = a.xa[e] + shift[:, 0], a.xb[e] + shift[:, 0], a.ya[e] + shift[:, 1]
        for q, f in b.index.candidates(ib[pair], xa, xb):
            left, right = np.maximum(xa[q], b.xa[f]), np.minimum(xb[q], b.xb[f])
            e0, e1 = (ya[q] + a.slope[e[q]] * (v - xa[q]) for v in (left, right))
            f0, f1 = (b.ya[f] + b.slope[f] * (v - b.xa[f]) for v in (left, right))
            d0, d1 = f0 - e0, f1 - e1
            split = np.divide(np.where(d0 < 0, d0 * d0, d1 * d1), np.abs(d0 - d1), out=np.zeros(len(q)), where=d0 != d1) / 2
            # area by which f lies below e: nothing, a whole trapezoid, or a triangle up to the crossing
            below = np.where((d0 >= 0) & (d1 >= 0), 0.0, np.where((d0 <= 0) & (d1 <= 0), (d0 + d1) / 2, -split))
            area = a.sign[e[q]] * b.sign[f] * (right - left) * ((e0 + e1) / 2 + below)
            out += np.bincount(pair[q], weights=area, minlength=len(out))
    return out


# --- validity ----------------------------------------------------------------------------------

#: In the order in which they are looked for.
REASONS = (
    "empty", "ring not closed", "too few points", "self-intersection", "hole outside its shell", "holes overlap", "parts overlap", "interior is cut",
)
NONE, CROSSED, OUTSIDE, HOLES, PARTS, CUT = len(REASONS), 3, 4, 5, 6, 7


def _touch(e: Edges, i: np.ndarray, j: np.ndarray, a, b, c) -> tuple[np.ndarray, np.ndarray]:
    """The point that two edges share which do not cross: an end of one on the other."""
    i_low, i_high = (np.stack(v, 1) for v in zip(*[e.take(i).extent(k) for k in (True, False)]))

    def on(x, y):
        p = np.stack([x, y], 1)
        return ((i_low <= p) & (p <= i_high)).all(1)

    first = (a == 0) & on(e.x1[j], e.y1[j])
    second = ~first & (b == 0) & on(e.x2[j], e.y2[j])
    third = ~first & ~second & (c == 0)
    x = np.where(first, e.x1[j], np.where(second, e.x2[j], np.where(third, e.x1[i], e.x2[i])))
    y = np.where(first, e.y1[j], np.where(second, e.y2[j], np.where(third, e.y1[i], e.y2[i])))
    return x, y


def faults(shapes: Shapes) -> np.ndarray:
    """Per geometry the place in ``REASONS`` of what is wrong with its polygons, or ``NONE``.

    Rings may touch each other in points, as long as the inside stays in one piece. Members of a collection are
    judged each for itself.
    """
    out = np.full(shapes.n, NONE)
    rings = len(shapes.part)
    size = np.bincount(shapes.ring, minlength=rings)
    end = np.cumsum(size) - 1
    start = end - size + 1
    solid = (shapes.kind[shapes.part] == SOLID) if rings else np.zeros(0, bool)
    owner = shapes.geom[shapes.part]
    some = size > 0
    gap = np.zeros(rings, bool)
    gap[some] = (np.abs(shapes.x[start[some]] - shapes.x[end[some]]) >= SAME_VERTEX) | (np.abs(shapes.y[start[some]] - shapes.y[end[some]]) >= SAME_VERTEX)
    np.minimum.at(out, owner[solid & (size < 4)], 2)
    np.minimum.at(out, owner[solid & (gap | ~some)], 1)
    out[np.bincount(owner, weights=size, minlength=shapes.n) == 0] = 0

    # edges of the rings that are left, the last vertex being the first, without those that have no length
    x, y = shapes.x.copy(), shapes.y.copy()
    x[end[some]], y[end[some]] = x[start[some]], y[start[some]]
    judged = solid & (out[owner] == NONE)
    at = np.flatnonzero((shapes.ring[1:] == shapes.ring[:-1]) & judged[shapes.ring[1:]])
    at = at[(x[at] != x[at + 1]) | (y[at] != y[at + 1])]
    e = Edges(x[at], y[at], x[at + 1], y[at + 1], shapes.ring[at])
    unit = np.unique(np.stack([owner, shapes.member[shapes.part]], 1), axis=0, return_inverse=True)[1].reshape(-1) if rings else owner
    units = int(unit.max()) + 1 if rings else 0
    group = unit[e.ring]
    inner = np.searchsorted(e.ring, np.arange(rings))
    number = np.arange(len(at)) - inner[e.ring]
    last = np.bincount(e.ring, minlength=rings) - 1

    def mark(rank: int, edges: np.ndarray) -> None:
        np.minimum.at(out, owner[e.ring[edges]], rank)

    # the axis along which edges reach less far keeps fewer of them in a slab
    reach = [np.bincount(group, weights=high - low, minlength=units) for low, high in (e.extent(False), e.extent(True))]
    touches = []
    for i, j in Slabs(*e.extent((reach[1] < reach[0])[group]), group, units).pairs():
        meet, a, b, c, d = e.sides(i, e, j)
        i, j, a, b, c, d = i[meet], j[meet], a[meet], b[meet], c[meet], d[meet]
        same = e.ring[i] == e.ring[j]
        step = number[j] - number[i]
        following = same & (step == 1)
        closing = same & (step == last[e.ring[i]]) & (number[i] == 0)
        along = (e.x2[i] - e.x1[i]) * (e.x2[j] - e.x1[j]) + (e.y2[i] - e.y1[i]) * (e.y2[j] - e.y1[j])
        flat = (a == 0) & (b == 0)
        back = (following | closing) & flat & (along < 0)
        mark(CROSSED, i[(same & ~following & ~closing) | back])
        # edges on one line share more than a point where their extents do
        li, hi = np.stack([v for k in (True, False) for v in e.take(i).extent(k)]), np.stack([v for k in (True, False) for v in e.take(j).extent(k)])
        run = flat & ((np.minimum(li[1], hi[1]) > np.maximum(li[0], hi[0])) | (np.minimum(li[3], hi[3]) > np.maximum(li[2], hi[2])))
        bad = ~same & ((a * b * c * d > 0) | run)
        mark_rank = _relation(shapes, e.ring[i], e.ring[j])
        np.minimum.at(out, owner[e.ring[i[bad]]], mark_rank[bad])
        point = ~same & ~bad
        if point.any():
            touches.append((i[point], j[point], *_touch(e, i[point], j[point], a[point], b[point], c[point])))
    i, j, tx, ty = (np.concatenate(t) for t in zip(*touches)) if touches else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 2
    fine = out[owner[e.ring[i]]] > CROSSED
    i, j, tx, ty = i[fine], j[fine], tx[fine], ty[fine]
    _places(shapes, e, group, units, i, j, tx, ty, out)
    near = shapes.part[e.ring[i]] == shapes.part[e.ring[j]]
    found = owner[e.ring[i]]
    order = np.flatnonzero(near)[np.argsort(found[near], kind="stable")]
    for here in np.split(order, np.flatnonzero(np.diff(found[order])) + 1):
        if len(here) > 1 and out[found[here[0]]] > CUT:
            if _cyclic(e.ring[i[here]].tolist(), e.ring[j[here]].tolist(), list(zip(tx[here].tolist(), ty[here].tolist()))):
                out[found[here[0]]] = CUT
    return out


def _relation(shapes: Shapes, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """What it is called when two rings are in each other's way."""
    same = shapes.part[one] == shapes.part[other]
    shell = (shapes.place[one] == 0) | (shapes.place[other] == 0)
    return np.where(~same, PARTS, np.where(shell, OUTSIDE, HOLES))


def _places(shapes: Shapes, e: Edges, group, units: int, i, j, tx, ty, out: np.ndarray) -> None:
    """Marks rings on the wrong side of others, by one position of a ring that touches none, or of each stretch between touches."""
    owner = shapes.geom[shapes.part]
    several = np.bincount(group, minlength=units) > 0
    rings_of = np.bincount(np.unique(np.stack([group, e.ring], 1), axis=0)[:, 0], minlength=units) if len(group) else np.zeros(units)
    touched = np.zeros(len(shapes.part), bool)
    touched[e.ring[i]] = touched[e.ring[j]] = True
    asked = several[group] & (rings_of[group] > 1) & (out[owner[e.ring]] > CROSSED)
    first = np.concatenate([[True], e.ring[1:] != e.ring[:-1]]) if len(e.ring) else np.zeros(0, bool)
    # each edge is cut at its touches; of the stretches the middles are asked
    at = np.flatnonzero(asked & (touched[e.ring] | first))
    edge = np.concatenate([at, i, j])
    sx, sy = np.concatenate([e.x1[at], tx, tx]), np.concatenate([e.y1[at], ty, ty])
    along = (sx - e.x1[edge]) * (e.x2[edge] - e.x1[edge]) + (sy - e.y1[edge]) * (e.y2[edge] - e.y1[edge])
    keep = asked[edge]
    edge, sx, sy, along = edge[keep], sx[keep], sy[keep], along[keep]
    order = np.lexsort((along, edge))
    edge, sx, sy = edge[order], sx[order], sy[order]
    final = np.append(edge[1:] != edge[:-1], True) if len(edge) else np.zeros(0, bool)
    ex, ey = np.where(final, e.x2[edge], np.roll(sx, -1)), np.where(final, e.y2[edge], np.roll(sy, -1))
    long = (sx != ex) | (sy != ey)
    edge, px, py = edge[long], ((sx + ex) / 2)[long], ((sy + ey) / 2)[long]
    ring = e.ring[edge]
    if not len(ring):
        return
    # rings without a touch are asked by a vertex, which is exact
    plain = ~touched[ring]
    px[plain], py[plain] = e.x1[edge[plain]], e.y1[edge[plain]]
    index = Slabs(*e.extent(), group, units)
    rings, odd = len(shapes.part) + 1, [np.zeros(0, np.int64)]
    for q, m in index.candidates(group[edge], py, py):
        x1, y1, x2, y2 = e.x1[m], e.y1[m], e.x2[m], e.y2[m]
        spans = ((y1 > py[q]) != (y2 > py[q])) & (e.ring[m] != ring[q])
        rise = np.divide(py[q] - y1, y2 - y1, out=np.zeros(len(q)), where=y1 != y2)
        odd.append((q * rings + e.ring[m])[spans & (px[q] < (x2 - x1) * rise + x1)])
    inside, times = np.unique(np.concatenate(odd), return_counts=True)
    inside = inside[times % 2 == 1]
    q, holder = inside // rings, inside % rings
    part, place = shapes.part, shapes.place
    same = part[holder] == part[ring[q]]
    hole = place[ring] > 0
    in_shell = np.zeros(len(ring), bool)
    in_shell[q[same & (place[holder] == 0)]] = True
    np.minimum.at(out, owner[ring[hole & ~in_shell]], OUTSIDE)
    np.minimum.at(out, owner[ring[q[same & hole[q] & (place[holder] > 0)]]], HOLES)
    # a shell in another part's shell, but in none of its holes
    other = ~same & ~hole[q]
    key = q * (len(shapes.geom) + 1) + part[holder]
    covered = np.setdiff1d(key[other & (place[holder] == 0)], key[other & (place[holder] > 0)])
    np.minimum.at(out, owner[ring[covered // (len(shapes.geom) + 1)]], PARTS)


def _cyclic(one: list, other: list, points: list) -> bool:
    """Whether rings and the points in which they touch make a circle, which cuts the inside in two."""
    parent: dict = {}

    def root(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    for ring, point in dict.fromkeys([(r, p) for rings in (one, other) for r, p in zip(rings, points)]):
        a, b = root(ring), root(point)
        if a == b:
            return True
        parent[a] = b
    return False


# --- boxes -------------------------------------------------------------------------------------


class _Sized:
    """Boxes of about one size in columns of their left sides, sorted in a column by their lower sides.

    Each lies in one place only. A query looks as far to the left and below as these boxes reach.
    """

    def __init__(self, at: np.ndarray, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray):
        x, y = x0[at], y0[at]
        self.reach = float((x1[at] - x).max()), float((y1[at] - y).max())
        self.left, self.right, self.far = x.min(), x.max(), float(np.abs(y).max())
        extent = self.right - self.left
        bound = 4 * extent / self.reach[0] if self.reach[0] > 0 else len(at)
        self.number = int(max(1, min(math.sqrt(len(at)), bound)))
        self.width = extent / self.number or 1.0
        column = self.column(x)
        order = np.lexsort((y, column))
        self.heights = np.sort(y)
        self.key = column[order] * (len(at) + 1) + np.searchsorted(self.heights, y[order])
        self.members = at[order]
        self.x0, self.x1, self.y1 = x[order], x1[self.members], y1[self.members]

    def column(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.floor((x - self.left) / self.width), 0, self.number - 1).astype(np.int64)

    def candidates(self, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        # a little further, as differences are rounded
        near_x = x0 - self.reach[0] - 1e-15 * (np.abs(x0) + self.reach[0] + max(abs(self.left), abs(self.right)))
        near_y = y0 - self.reach[1] - 1e-15 * (np.abs(y0) + self.reach[1] + self.far)
        low, high = np.searchsorted(self.heights, near_y), np.searchsorted(self.heights, y1, side="right")
        asked = np.flatnonzero((x1 >= self.left) & (near_x <= self.right) & (low < high))
        first = self.column(near_x[asked])
        counts = self.column(x1[asked]) - first + 1
        for part in steps(counts, BOX_STEP):
            entry, column = spread(first[part], counts[part])
            query = asked[part][entry]
            base = column * (len(self.members) + 1)
            start, end = np.searchsorted(self.key, base + low[query]), np.searchsorted(self.key, base + high[query])
            for some in steps(end - start, BOX_STEP):
                entry, at = spread(start[some], (end - start)[some])
                who = query[some][entry]
                near = (x0[who] <= self.x1[at]) & (self.x0[at] <= x1[who]) & (y0[who] <= self.y1[at])
                if near.all():
                    if len(who):
                        yield who, self.members[at]
                elif near.any():
                    yield who[near], self.members[at[near]]


class Boxes:
    """Boxes by size, a fourfold range each, so that a query that is far smaller than some of them looks at few it does not meet."""

    def __init__(self, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray):
        size = np.maximum(x1 - x0, y1 - y0)
        some = np.flatnonzero(size >= 0)
        ratio = np.divide(size[some], size[some].max(initial=0.0), out=np.zeros(len(some)), where=size[some] > 0)
        level = np.clip(np.ceil(np.log2(np.maximum(ratio, 2.0**-SIZES)) / 2), -SIZES // 2, 0)
        self.sizes = [_Sized(some[level == one], x0, y0, x1, y1) for one in np.unique(level)]

    def candidates(self, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, box) of boxes that meet, each once, in steps."""
        for sized in self.sizes:
            yield from sized.candidates(x0, y0, x1, y1)
