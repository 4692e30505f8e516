"""The binary codec against a plain reader and writer."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest

from geosync.functions import planar, wkb

SIMPLE = ("point", "linestring", "polygon")


def pack(kind, parts, srid=0, order="<"):
    """One geometry by itself; ``parts`` are (kind, rings)."""
    code = wkb.CODES[kind]
    head = (b"\1" if order == "<" else b"\0") + struct.pack(order + "I", code | (wkb.SRID_FLAG if srid else 0)) + (struct.pack(order + "I", srid) if srid else b"")
    if kind not in SIMPLE:
        return head + struct.pack(order + "I", len(parts)) + b"".join(pack(*p, order=order) for p in parts)
    rings = parts[0][1] if parts else []
    line = lambda r: struct.pack(order + "I", len(r)) + b"".join(struct.pack(order + "2d", *v) for v in r)
    if kind == "point":
        return head + struct.pack(order + "2d", *(rings[0][0] if rings else (np.nan, np.nan)))
    if kind == "linestring":
        return head + (line(rings[0]) if rings else struct.pack(order + "I", 0))
    return head + struct.pack(order + "I", len(rings)) + b"".join(map(line, rings))


def some(rng, depth=0):
    """A geometry as (kind, parts for ``pack``, parts of the struct)."""
    kind = rng.choice([*wkb.CODES][: 7 if depth < 2 else 6])

    def leaf(name):
        at = lambda: (rng.uniform(-180, 180), rng.uniform(-90, 90))
        sizes = {"point": [1], "linestring": [rng.randint(2, 6)], "polygon": [rng.randint(4, 7) for _ in range(rng.randint(1, 3))]}[name]
        return [[at() for _ in range(size)] for size in sizes]

    if kind in SIMPLE:
        rings = leaf(kind)
        return kind, [(kind, rings)], [(kind, 0, rings)]
    if kind != "geometrycollection":
        name = kind.removeprefix("multi")
        held = [leaf(name) for _ in range(rng.randint(2, 4))]
        return kind, [(name, [(name, r)]) for r in held], [(name, 0, r) for r in held]
    members = [some(rng, depth + 1) for _ in range(rng.randint(1, 3))]
    parts, number = [], 0
    for _, _, own in members:
        base = number
        for name, m, rings in own:
            parts.append((name, base + m, rings))
            number = max(number, base + m + 1)
    return kind, [(k, p) for k, p, _ in members], parts


def as_struct(kind, parts, srid):
    return {"kind": kind, "srid": srid, "parts": [{"kind": k, "member": m, "rings": [[{"x": x, "y": y} for x, y in r] for r in rings]} for k, m, rings in parts]}


@pytest.mark.parametrize("seed", range(4))
def test_both_ways(seed):
    rng = random.Random(seed)
    found = [some(rng) for _ in range(200)]
    flat = [(k, p, own) for k, p, own in found if k != "geometrycollection" or all(x[0] != "geometrycollection" for x in p)]
    structs = [as_struct(k, own, 4326) for k, _, own in flat]
    array = pa.array([*structs, None], planar._GEOMETRY)
    blobs = wkb.encode(array)
    assert blobs.to_pylist() == [pack(k, p, 4326) for k, p, _ in flat] + [None]
    assert wkb.decode(blobs, 4326).to_pylist() == [*structs, None]
    # collections in collections, and the other byte order
    for order in "<>":
        blobs = pa.array([pack(k, p, rng.choice((0, 77)), order) for k, p, _ in found], pa.binary())
        assert wkb.decode(blobs, 5).to_pylist() == [as_struct(k, own, 5) for k, _, own in found]
        assert wkb.decode(blobs.slice(7, 20), 5).to_pylist() == [as_struct(k, own, 5) for k, _, own in found][7:27]


def test_empty_broken_and_higher():
    empty = [pack(kind, []) for kind in wkb.CODES]
    assert [g["parts"] for g in wkb.decode(pa.array(empty, pa.binary()), 0).to_pylist()] == [[]] * 7
    array = pa.array([as_struct(kind, [], 0) for kind in wkb.CODES], planar._GEOMETRY)
    assert wkb.encode(array).to_pylist() == empty
    whole = pack("multipolygon", [("polygon", [("polygon", [[(0, 0), (1, 0), (1, 1), (0, 0)]])])], 4326)
    broken = [whole[:k] for k in range(len(whole))] + [b"\1" + struct.pack("<I", 99), b"\1" + struct.pack("<II", 2, 4_000_000_000), None]
    broken.append(b"".join(b"\1" + struct.pack("<II", 7, 1) for _ in range(40)))
    assert wkb.decode(pa.array(broken, pa.binary()), 0).to_pylist() == [None] * len(broken)
    line = struct.pack("<I6d", 2, 1, 2, 9, 3, 4, 9)
    for code in (2 | wkb.Z_FLAG, 1002, 2002):
        got = wkb.decode(pa.array([b"\1" + struct.pack("<I", code) + line], pa.binary()), 0).to_pylist()[0]
        assert got["parts"][0]["rings"] == [[{"x": 1.0, "y": 2.0}, {"x": 3.0, "y": 4.0}]]
    assert wkb.decode(pa.array([], pa.binary()), 0).to_pylist() == [] == wkb.encode(pa.array([], planar._GEOMETRY)).to_pylist()
