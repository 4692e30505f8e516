"""Polygons made anew from rings that cross: a plane arrangement for each geometry, inside by the even-odd rule.

The lines of a whole batch are cut and followed together, each with the number of its geometry.
"""

from __future__ import annotations

import math
from itertools import chain

import numpy as np

from geosync.functions.shapes import Edges, Slabs, spread, steps

#: Decimals of a crossing point, and rounds in which edges are cut, as cut edges may meet others anew.
DECIMALS = 11
ROUNDS = 12

Ring = list[tuple[float, float]]


def _odd(lines: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each line (x1, y1, x2, y2) of a group once, from its lesser end, if it is there an odd number of times; by group."""
    turned = (lines[:, 0] > lines[:, 2]) | ((lines[:, 0] == lines[:, 2]) & (lines[:, 1] > lines[:, 3]))
    lines = np.where(turned[:, None], lines[:, [2, 3, 0, 1]], lines)
    some = (lines[:, :2] != lines[:, 2:]).any(1)
    lines, group = lines[some], group[some]
    order = np.lexsort((*lines.T[::-1], group))
    lines, group = lines[order], group[order]
    first = np.flatnonzero(_changes(group, *lines.T))
    times = np.diff(np.append(first, len(lines)))
    once = first[times % 2 == 1]
    return lines[once], group[once]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for column in columns:
        out[1:] |= column[1:] != column[:-1]
    return out


def noded(lines: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines cut wherever they meet others of their group, those that cancel out left away, by group.

    A group has none if its lines all cancel out or if cutting them does not come to an end.
    """
    lines, group = _odd(lines, group)
    done = []
    for _ in range(ROUNDS):
        n = len(lines)
        e = Edges(*lines.T, group)
        reach = [np.bincount(group, weights=high - low, minlength=groups) for low, high in (e.extent(False), e.extent(True))]
        cuts = []
        for i, j in Slabs(*e.extent((reach[1] < reach[0])[group]), group, groups).pairs():
            meet, a, b, c, d = e.sides(i, e, j)
            i, j, a, b, c, d = i[meet], j[meet], a[meet], b[meet], c[meet], d[meet]
            proper = a * b * c * d > 0
            p, q = i[proper], j[proper]
            dx, dy, fx, fy = e.x2[p] - e.x1[p], e.y2[p] - e.y1[p], e.x2[q] - e.x1[q], e.y2[q] - e.y1[q]
            t = ((e.x1[q] - e.x1[p]) * fy - (e.y1[q] - e.y1[p]) * fx) / (dx * fy - dy * fx)
            x, y = np.round(e.x1[p] + t * dx, DECIMALS), np.round(e.y1[p] + t * dy, DECIMALS)
            cuts += [(p, x, y), (q, x, y)]
            # ends of one on the other
            for line, x, y, side in ((i, e.x1[j], e.y1[j], a), (i, e.x2[j], e.y2[j], b), (j, e.x1[i], e.y1[i], c), (j, e.x2[i], e.y2[i], d)):
                on = (side == 0) & (np.minimum(e.x1[line], e.x2[line]) <= x) & (x <= np.maximum(e.x1[line], e.x2[line]))
                on &= (np.minimum(e.y1[line], e.y2[line]) <= y) & (y <= np.maximum(e.y1[line], e.y2[line]))
                cuts.append((line[on], x[on], y[on]))
        line, x, y = (np.concatenate(v) for v in zip(*cuts)) if cuts else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
        inner = ((x != e.x1[line]) | (y != e.y1[line])) & ((x != e.x2[line]) | (y != e.y2[line]))
        open_groups = np.zeros(groups, bool)
        open_groups[group[line[inner]]] = True
        whole = ~open_groups[group]
        done.append((lines[whole], group[whole]))
        if whole.all():
            break
        left = np.flatnonzero(~whole)
        line = np.concatenate([left, line[inner]])
        x, y = np.concatenate([e.x1[left], x[inner]]), np.concatenate([e.y1[left], y[inner]])
        along = (x - e.x1[line]) * (e.x2 - e.x1)[line] + (y - e.y1[line]) * (e.y2 - e.y1)[line]
        order = np.lexsort((along, line))
        line, x, y = line[order], x[order], y[order]
        final = np.append(line[1:] != line[:-1], True)
        lines, group = _odd(
            np.stack([x, y, np.where(final, e.x2[line], np.roll(x, -1)), np.where(final, e.y2[line], np.roll(y, -1))], axis=1), group[line]
        )
    lines, group = (np.concatenate(v) for v in zip(*done))
    order = np.argsort(group, kind="stable")
    return lines[order], group[order]


def _cycles(start: np.ndarray, points: np.ndarray) -> list[list[int]]:
    """Half-edges around each face, the face on their left. Half-edge h and h ^ 1 are one line in both directions."""
    way = points[start[np.arange(len(start)) ^ 1]] - points[start]
    order = np.lexsort((np.arctan2(way[:, 1], way[:, 0]), start))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    first = np.searchsorted(start[order], np.arange(len(points)))
    count = np.bincount(start, minlength=len(points))
    # at the end of a half-edge turn to the next one clockwise from where it came from
    back = np.arange(len(start)) ^ 1
    at = place[back]
    vertex = start[back]
    following = order[np.where(at > first[vertex], at - 1, first[vertex] + count[vertex] - 1)].tolist()
    seen = [False] * len(following)
    out = []
    for h in range(len(following)):
        cycle = []
        while not seen[h]:
            seen[h] = True
            cycle.append(h)
            h = following[h]
        if cycle:
            out.append(cycle)
    return out


def _loops(path: list[int]) -> list[list[int]]:
    """A closed path as loops that visit no vertex twice."""
    loops, stack, seen = [], [], {}
    for v in [*path, path[0]]:
        if v in seen:
            loop = stack[seen[v] :]
            for gone in loop[1:]:
                del seen[gone]
            del stack[seen[v] + 1 :]
            if len(loop) > 2:
                loops.append(loop)
        else:
            seen[v] = len(stack)
            stack.append(v)
    return loops


def _area(ring: np.ndarray) -> float:
    d = ring - ring[0]
    n = np.roll(d, -1, axis=0)
    return math.fsum((d[:, 0] * n[:, 1] - n[:, 0] * d[:, 1]).tolist()) / 2


def _inside(x: float, y: float, ring: np.ndarray) -> bool:
    n = np.roll(ring, -1, axis=0)
    spans = (ring[:, 1] > y) != (n[:, 1] > y)
    a, b = ring[spans], n[spans]
    return int((x < (b[:, 0] - a[:, 0]) * (y - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]).sum()) % 2 == 1


def _inner(cycles: list[list[int]], start: np.ndarray, points: np.ndarray, lines: np.ndarray, group: np.ndarray, groups: int) -> list[int]:
    """The places of the cycles that have the inside on their left.

    The lines of a group above the middle of a cycle's widest half-edge tell whether what lies just above it is inside.
    """
    size = np.array([len(c) for c in cycles], np.int64)
    halves = np.fromiter(chain.from_iterable(cycles), np.int64, int(size.sum()))
    owner = np.repeat(np.arange(len(cycles)), size)
    length = points[start[halves ^ 1], 0] - points[start[halves], 0]
    order = np.lexsort((-np.abs(length), owner))
    widest = order[np.cumsum(size) - size]
    line, length = halves[widest] // 2, length[widest]
    x1, y1, x2, y2 = lines.T
    mx, my = (x1[line] + x2[line]) / 2, (y1[line] + y2[line]) / 2
    first = np.searchsorted(group, np.arange(groups + 1))
    asked = np.flatnonzero(length != 0)
    of = group[line[asked]]
    counts = first[of + 1] - first[of]
    above = np.zeros(len(cycles), np.int64)
    for part in steps(counts):
        q, at = spread(first[of[part]], counts[part])
        q = asked[part][q]
        spans = ((x1[at] <= mx[q]) != (x2[at] <= mx[q])) & (at != line[q])
        q, at = q[spans], at[spans]
        over = y1[at] + (mx[q] - x1[at]) * (y2[at] - y1[at]) / (x2[at] - x1[at]) > my[q]
        above += np.bincount(q[over], minlength=len(cycles))
    return np.flatnonzero((length != 0) & ((above % 2 == 1) == (length > 0))).tolist()


def _closed(ring: np.ndarray) -> Ring:
    points = [tuple(v) for v in ring.tolist()]
    first = points.index(min(points))
    return [*points[first:], *points[: first + 1]]


def _assembled(made: list, loose: list[np.ndarray]) -> list[list[Ring]] | None:
    """Polygons of shells with their holes, and of holes whose shell is still to be found; None if one has none."""
    for hole in loose:
        middle = (hole[0] + hole[1]) / 2
        around = [m for m in made if _inside(middle[0], middle[1], m[0])]
        around = [m for m in around if _area(m[0]) > -_area(hole)]
        if not around:
            return None
        min(around, key=lambda m: _area(m[0]))[1].append(hole)
    return sorted([_closed(shell), *sorted(map(_closed, holes))] for shell, holes in made) or None


def rebuilt_all(geometries: list[list[Ring]]) -> list[list[list[Ring]] | None]:
    """For the rings of each geometry polygons (shell and holes, closed) of what lies inside an odd number of them; None if
    they can't be made.

    Lines that the rings hold twice, such as spikes, bound nothing and go. Shells turn counter-clockwise, holes clockwise.
    """
    rings = [(k, r) for k, geometry in enumerate(geometries) for r in geometry if r]
    if not rings:
        return [None] * len(geometries)
    size = np.array([len(r) for _, r in rings], np.int64)
    xy = np.array([v for _, r in rings for v in r], np.float64).reshape(-1, 2)
    following = np.arange(1, len(xy) + 1)
    end = np.cumsum(size)
    following[end - 1] = end - size
    lines, group = noded(np.hstack([xy, xy[following]]), np.repeat(np.array([k for k, _ in rings], np.int64), size), len(geometries))
    if not len(lines):
        return [None] * len(geometries)
    ends, of = lines.reshape(-1, 2), np.repeat(group, 2)
    order = np.lexsort((ends[:, 1], ends[:, 0], of))
    new = _changes(of[order], ends[order, 0], ends[order, 1])
    points = ends[order][new]
    start = np.empty(len(ends), np.int64)
    start[order] = np.cumsum(new) - 1
    cycles = _cycles(start, points)
    vertex, owner = start.tolist(), group.tolist()
    made: dict[int, tuple[list, list]] = {}
    failed = set()
    for c in _inner(cycles, start, points, lines, group, len(geometries)):
        k = owner[cycles[c][0] // 2]
        solids, loose = made.setdefault(k, ([], []))
        loops = [points[loop] for loop in _loops([vertex[h] for h in cycles[c]])]
        sizes = [_area(loop) for loop in loops]
        shells = [loop for loop, area in zip(loops, sizes) if area > 0]
        holes = [loop for loop, area in zip(loops, sizes) if area < 0]
        if len(shells) > 1:
            failed.add(k)
        elif shells:
            solids.append((shells[0], holes))
        else:
            loose += holes
    return [_assembled(*made[k]) if k in made and k not in failed else None for k in range(len(geometries))]


def rebuilt(rings: list[Ring]) -> list[list[Ring]] | None:
    """The same for one geometry."""
    return rebuilt_all([rings])[0]
