"""Well-known binary, read and written for a whole Arrow batch at once.

Writing places every header, count and vertex of the batch by running sums of their sizes. Reading goes through all
values of a batch in step: one pass reads the next header of each, and the coordinates are gathered at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from geosync.functions import planar
from geosync.functions.shapes import DOT, KINDS, LINE, SOLID, Shapes, spread

# Geometry codes of the format, the flags of EWKB, and how deep collections may lie in each other.
POINT, LINESTRING, POLYGON, COLLECTION = 1, 2, 3, 7
CODES = {"point": 1, "linestring": 2, "polygon": 3, "multipoint": 4, "multilinestring": 5, "multipolygon": 6, "geometrycollection": 7}
SRID_FLAG, Z_FLAG, M_FLAG = 0x20000000, 0x80000000, 0x40000000
DEPTH = 16

_PART_CODE = np.zeros(3, np.int64)
_PART_CODE[[SOLID, LINE, DOT]] = POLYGON, LINESTRING, POINT


def _put(data: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Little-endian ``values`` at bytes ``at``."""
    raw = values.view(np.uint8).reshape(len(values), values.dtype.itemsize)
    data[at[:, None] + np.arange(raw.shape[1])] = raw


def _before(sizes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Sum of the sizes before each item within its owner; items of an owner stand together."""
    running = np.cumsum(sizes) - sizes
    first = np.searchsorted(owner, owner)
    return running - running[first] if len(sizes) else running


def encode(array: pa.Array) -> pa.Array:
    """Little-endian EWKB of geometries; null for a null one."""
    s = Shapes(array)
    kind = array.flatten()[array.type.get_field_index("kind")]
    names = pa.array(list(CODES), kind.type)
    place = pc.fill_null(pc.index_in(kind, value_set=names), -1).to_numpy(zero_copy_only=False)
    known = place >= 0
    code = place + 1
    srid = pc.fill_null(array.flatten()[array.type.get_field_index("srid")], 0).to_numpy(zero_copy_only=False).astype(np.int64)
    head = np.where(srid != 0, 9, 5)
    nested = code > POLYGON

    count = np.bincount(s.ring, minlength=len(s.part))
    ring_kind = s.kind[s.part]
    ring_size = np.where(ring_kind == DOT, 0, 4) + 16 * count
    body = np.bincount(s.part, weights=ring_size, minlength=len(s.geom)).astype(np.int64) + np.where(s.kind == SOLID, 4, 0)
    # members of a collection that have several parts stand as a multi geometry
    whole = s.geom * (int(s.member.max()) + 1 if len(s.member) else 1) + s.member
    opens = np.concatenate([[True], whole[1:] != whole[:-1]]) if len(whole) else np.zeros(0, bool)
    group = np.cumsum(opens) - 1
    several = np.bincount(group, minlength=len(opens))[group] > 1
    lead = np.where((code[s.geom] == COLLECTION) & opens & several, 9, 0)
    own = np.where(nested[s.geom], 5, 0)
    part_size = lead + own + body
    bare = np.bincount(s.geom, minlength=s.n) == 0
    total = head + np.where(nested, 4, 0) + np.bincount(s.geom, weights=part_size, minlength=s.n).astype(np.int64)
    total += np.where(bare & ~nested, np.where(code == POINT, 16, 4), 0)
    total = np.where(known, total, 0)

    ends = np.cumsum(total)
    start = ends - total
    data = np.zeros(int(ends[-1]) if s.n else 0, np.uint8)

    def header(at: np.ndarray, codes: np.ndarray) -> None:
        data[at] = 1
        _put(data, at + 1, codes.astype("<u4"))

    some = np.flatnonzero(known)
    header(start[some], code[some] | np.where(srid[some] != 0, SRID_FLAG, 0))
    marked = some[srid[some] != 0]
    _put(data, start[marked] + 5, srid[marked].astype("<u4"))
    empty = some[bare[some] & (code[some] == POINT)]
    for k in (0, 8):
        _put(data, start[empty] + head[empty] + k, np.full(len(empty), np.nan, "<f8"))
    groups = np.bincount(s.geom[opens], minlength=s.n)
    parts = np.bincount(s.geom, minlength=s.n)
    multi = some[nested[some]]
    _put(data, start[multi] + head[multi], np.where(code[multi] == COLLECTION, groups[multi], parts[multi]).astype("<u4"))

    at = start[s.geom] + head[s.geom] + np.where(nested[s.geom], 4, 0) + _before(part_size, s.geom)
    lone = np.flatnonzero(lead > 0)
    header(at[lone], _PART_CODE[s.kind[lone]] + 3)
    _put(data, at[lone] + 5, np.bincount(group, minlength=len(opens))[group[lone]].astype("<u4"))
    at = at + lead
    header(at[own > 0], _PART_CODE[s.kind[own > 0]])
    at = at + own
    solid = np.flatnonzero(s.kind == SOLID)
    _put(data, at[solid], np.bincount(s.part, minlength=len(s.geom))[solid].astype("<u4"))
    ring_at = at[s.part] + np.where(ring_kind == SOLID, 4, 0) + _before(ring_size, s.part)
    counted = np.flatnonzero(ring_kind != DOT)
    _put(data, ring_at[counted], count[counted].astype("<u4"))
    vertex_at = ring_at[s.ring] + np.where(ring_kind[s.ring] == DOT, 0, 4) + 16 * (np.arange(len(s.ring)) - np.searchsorted(s.ring, s.ring))
    _put(data, vertex_at, s.x.astype("<f8"))
    _put(data, vertex_at + 8, s.y.astype("<f8"))
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), s.n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pc.if_else(pa.array(known), made, pa.scalar(None, pa.large_binary())).cast(pa.binary())


class _Reader:
    """Values read in step: each with its place, and how many parts it must still read on each level."""

    def __init__(self, blobs: pa.Array):
        large = blobs.cast(pa.large_binary())
        _, offsets, data = large.buffers()
        ends = np.frombuffer(offsets, np.int64)[large.offset : large.offset + len(large) + 1]
        self.data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.at, self.end = ends[:-1].copy(), ends[1:]
        self.good = np.asarray(large.is_valid())
        self.little = np.ones(len(blobs), bool)

    def _bytes(self, at: np.ndarray, width: int, little: np.ndarray) -> np.ndarray:
        way = np.where(little[:, None], np.arange(width), np.arange(width)[::-1])
        return np.ascontiguousarray(self.data[at[:, None] + way])

    def room(self, who: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Those of ``who`` whose value has so many bytes left; the others can't be read."""
        fits = self.at[who] + size <= self.end[who]
        self.good[who[~fits]] = False
        return who[fits]

    def order(self, who: np.ndarray) -> None:
        self.little[who] = self.data[self.at[who]] == 1
        self.at[who] += 1

    def number(self, who: np.ndarray) -> np.ndarray:
        value = self._bytes(self.at[who], 4, self.little[who]).view("<u4").reshape(-1).astype(np.int64)
        self.at[who] += 4
        return value

    def positions(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        return self._bytes(at, 8, little).view("<f8").reshape(-1)


def decode(blobs: pa.Array, srid: int) -> pa.Array:
    """Geometries of WKB or EWKB, collections flattened; null where a value cannot be read."""
    r = _Reader(blobs)
    n = len(blobs)
    left = np.zeros((n, DEPTH), np.int64)
    inside = np.zeros((n, DEPTH), np.int64)  # the code of the geometry whose parts a level counts
    depth = np.full(n, -1)
    kind, member = np.zeros(n, np.int64), np.full(n, -1)
    parts: list[tuple[np.ndarray, ...]] = []  # geometry, code, member
    rings: list[tuple[np.ndarray, ...]] = []  # part, place, vertices, numbers of a vertex, byte order
    made = 0
    active = np.flatnonzero(r.good)
    while len(active):
        who = r.room(active, 5)
        r.order(who)
        raw = r.number(who)
        flagged = who[(raw & SRID_FLAG) != 0]
        r.at[r.room(flagged, 4)] += 4
        plain = raw & 0x0FFFFFFF
        width = 2 + ((raw & Z_FLAG) != 0) + ((raw & M_FLAG) != 0) + np.array([0, 1, 1, 2])[np.minimum(plain // 1000, 3)]
        code = plain % 1000
        r.good[who[(code < 1) | (code > COLLECTION) | (plain >= 4000)]] = False
        top = depth[who] < 0
        kind[who[top]] = code[top]
        above = np.where(top, COLLECTION, inside[who, np.maximum(depth[who], 0)])
        # a leaf of its own unless it is a part of a multi geometry
        member[who[(above == COLLECTION) & (code != COLLECTION)]] += 1

        keep = r.good[who]
        who, code, width = who[keep], code[keep], width[keep]
        nest = code > POLYGON
        deep = who[nest]
        fits = np.isin(deep, r.room(deep, 4))
        deep, deep_code = deep[fits], code[nest][fits]
        several = r.number(deep)
        r.good[deep[(depth[deep] + 1 >= DEPTH) | (5 * several > r.end[deep] - r.at[deep])]] = False
        fits = r.good[deep]
        deep, deep_code, several = deep[fits], deep_code[fits], several[fits]
        depth[deep] += 1
        left[deep, depth[deep]], inside[deep, depth[deep]] = several, deep_code

        leaf, leaf_code, leaf_width = who[~nest], code[~nest], width[~nest]
        part = made + np.arange(len(leaf))
        made += len(leaf)
        parts.append((leaf, leaf_code, member[leaf]))
        count = np.ones(len(leaf), np.int64)
        solid = np.flatnonzero(leaf_code == POLYGON)
        fit = np.isin(leaf[solid], r.room(leaf[solid], 4))
        count[solid] = 0
        count[solid[fit]] = r.number(leaf[solid[fit]])
        todo = np.flatnonzero(r.good[leaf] & (count > 0))
        while len(todo):
            own = leaf[todo]
            size = np.ones(len(todo), np.int64)
            counted = np.flatnonzero(leaf_code[todo] != POINT)
            fit = np.isin(own[counted], r.room(own[counted], 4))
            size[counted[fit]] = r.number(own[counted[fit]])
            r.room(own, 8 * size * leaf_width[todo])
            fit = r.good[own]
            todo, own, size = todo[fit], own[fit], size[fit]
            rings.append((part[todo], r.at[own], size, leaf_width[todo], r.little[own]))
            r.at[own] += 8 * size * leaf_width[todo]
            count[todo] -= 1
            todo = todo[count[todo] > 0]

        done = leaf[depth[leaf] >= 0]
        left[done, depth[done]] -= 1
        active = who[r.good[who] & (depth[who] >= 0)]
        full = active[left[active, depth[active]] == 0]
        while len(full):
            depth[full] -= 1
            full = full[depth[full] >= 0]
            left[full, depth[full]] -= 1
            full = full[left[full, depth[full]] == 0]
        active = active[depth[active] >= 0]
    return _assembled(r, kind, parts, rings, srid)


def _assembled(r: _Reader, kind: np.ndarray, parts: list, rings: list, srid: int) -> pa.Array:
    n = len(kind)
    geom, code, member = (np.concatenate(v) for v in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
    owner, at, size, width, little = (np.concatenate(v) for v in zip(*rings)) if rings else (np.zeros(0, np.int64),) * 4 + (np.zeros(0, bool),)
    # an empty point is written as not-a-number
    dot = np.flatnonzero(code[owner] == POINT)
    size = size.copy()
    size[dot[np.isnan(r.positions(at[dot], little[dot]))]] = 0
    held = np.bincount(owner, weights=size, minlength=len(geom)) > 0
    keep = r.good[geom] & held
    order = np.flatnonzero(keep)[np.argsort(geom[keep], kind="stable")]
    place = np.full(len(geom), -1)
    place[order] = np.arange(len(order))
    ring = np.flatnonzero(place[owner] >= 0)
    ring = ring[np.argsort(place[owner[ring]], kind="stable")]
    which, step = spread(np.zeros(len(ring), np.int64), size[ring])
    first = at[ring][which] + 8 * width[ring][which] * step
    x, y = (r.positions(first + k, little[ring][which]) for k in (0, 8))
    vertices = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])

    def listed(counts: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)

    nested = listed(np.bincount(place[owner[ring]], minlength=len(order)), listed(size[ring], vertices))
    names = pa.array([{SOLID: KINDS[SOLID], LINE: KINDS[LINE], DOT: KINDS[DOT]}[k] for k in (DOT, LINE, SOLID)])
    own = np.where(kind[geom[order]] == COLLECTION, member[order], 0).astype(np.int32)
    whole = pa.StructArray.from_arrays([names.take(pa.array(code[order] - 1)), pa.array(own), nested], names=["kind", "member", "rings"])
    kinds = pa.array(list(CODES)).take(pa.array(np.maximum(kind - 1, 0), mask=~r.good))
    columns = [kinds, listed(np.bincount(geom[order], minlength=n), whole), pa.array(np.full(n, srid, np.int32))]
    return pa.StructArray.from_arrays(columns, names=["kind", "parts", "srid"], mask=pa.array(~r.good))


@F.arrow_udf(BinaryType())
def _to_ewkb(geom: pa.Array, _: pa.Array) -> pa.Array:
    return encode(geom)


def to_ewkb(geom: Column) -> Column:
    """Little-endian EWKB with the SRID in its head; ``geom`` must be a column of the frame."""
    return _to_ewkb(geom, geom["srid"])


def from_ewkb(blob: Column, srid: int = 4326) -> Column:
    """Geometry from WKB or EWKB; NULL when it cannot be read."""

    @F.arrow_udf(planar.GEOMETRY)
    def read(blobs: pa.Array) -> pa.Array:
        return decode(blobs, srid)

    return read(blob)


def ewkb_hash(geom: Column) -> Column:
    """MD5 of the EWKB, for comparison with hashes stored by a database."""
    return F.md5(to_ewkb(geom))
