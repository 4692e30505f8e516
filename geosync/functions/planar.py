"""Predicates, overlap, validity and repair as columns: Arrow functions over the kernels of ``shapes``.

Arguments must be columns of the frame. Each is named twice, by its SRID too, so that Spark keeps it as a column instead
of copying its expression into the function's arguments, where lambdas could not be evaluated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from geosync.functions import arrangement, geodesic
from geosync.functions import shapes as s

VERTEX = StructType([StructField("x", DoubleType()), StructField("y", DoubleType())])
PART = StructType([StructField("kind", StringType()), StructField("member", IntegerType()), StructField("rings", ArrayType(ArrayType(VERTEX)))])
GEOMETRY = StructType([StructField("kind", StringType()), StructField("parts", ArrayType(PART)), StructField("srid", IntegerType())])
VALIDITY = StructType([StructField("valid", BooleanType()), StructField("reason", StringType())])
EXAMINED = StructType([StructField("reason", StringType()), StructField("fixed", GEOMETRY)])

_VERTEX = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_PART = pa.struct([("kind", pa.string()), ("member", pa.int32()), ("rings", pa.list_(pa.list_(_VERTEX)))])
_GEOMETRY = pa.struct([("kind", pa.string()), ("parts", pa.list_(_PART)), ("srid", pa.int32())])


def _reasons(array: pa.Array) -> list[str | None]:
    names = [*s.REASONS, None]
    return [names[k] for k in s.faults(s.Shapes(array))]


@F.arrow_udf(BooleanType())
def _intersects(a: pa.Array, b: pa.Array, _: pa.Array, __: pa.Array) -> pa.Array:
    left, right = s.Prepared(s.Shapes(a)), s.Prepared(s.Shapes(b))
    every = np.arange(len(a))
    return pa.array(s.meets(left, right, every, every))


@F.arrow_udf(DoubleType())
def _overlap(a: pa.Array, b: pa.Array, _: pa.Array, __: pa.Array) -> pa.Array:
    every = np.arange(len(a))
    return pa.array(s.overlap(s.Borders(s.Shapes(a)), s.Borders(s.Shapes(b)), every, every))


@F.arrow_udf(DoubleType())
def _length(geom: pa.Array, _: pa.Array) -> pa.Array:
    shapes = s.Shapes(geom)
    first = np.flatnonzero((shapes.ring[1:] == shapes.ring[:-1]) & (shapes.kind[shapes.part[shapes.ring[1:]]] == s.LINE))
    metres = geodesic.distances(shapes.x[first], shapes.y[first], shapes.x[first + 1], shapes.y[first + 1])
    total = np.bincount(shapes.geom[shapes.part[shapes.ring[first]]], weights=metres, minlength=shapes.n)
    return pa.array(total, mask=~np.asarray(geom.is_valid()))


@F.arrow_udf(DoubleType())
def _distance(x1: pa.Array, y1: pa.Array, x2: pa.Array, y2: pa.Array) -> pa.Array:
    metres = geodesic.distances(*(v.to_numpy(zero_copy_only=False).astype(float) for v in (x1, y1, x2, y2)))
    return pa.array(metres, mask=np.isnan(metres))


@F.arrow_udf(VALIDITY)
def _validity(geom: pa.Array, _: pa.Array) -> pa.Array:
    reasons = _reasons(geom)
    return pa.StructArray.from_arrays([pa.array([r is None for r in reasons], pa.bool_()), pa.array(reasons, pa.string())], names=["valid", "reason"])


def mended(geoms: list[dict]) -> list[dict | None]:
    """Faulty geometries whose polygons are made anew, each member of a collection by itself; None where that can't be done."""
    members: list[tuple[int, int, list]] = []
    for k, geom in enumerate(geoms):
        solids: dict[int, list] = {}
        for p in geom["parts"]:
            if p["kind"] == "polygon":
                solids.setdefault(p["member"], []).append(p)
        members += [(k, member, own) for member, own in solids.items()]
    # Of a geometry with several members some may be sound.
    several = [n for n, (k, _, _) in enumerate(members) if any(0 <= m < len(members) and members[m][0] == k for m in (n - 1, n + 1))]
    alone = pa.array([{"kind": "multipolygon", "parts": members[n][2], "srid": None} for n in several], _GEOMETRY)
    sound = {n for n, reason in zip(several, _reasons(alone)) if reason is None}
    broken = [n for n in range(len(members)) if n not in sound]
    made = arrangement.rebuilt_all([[[(v["x"], v["y"]) for v in r] for q in members[n][2] for r in q["rings"]] for n in broken])
    parts: list[dict] = [{} for _ in geoms]
    for n in sound:
        k, member, own = members[n]
        parts[k][member] = own
    for n, polygons in zip(broken, made):
        k, member, _ = members[n]
        parts[k][member] = None if polygons is None else [
            {"kind": "polygon", "member": member, "rings": [[{"x": x, "y": y} for x, y in r] for r in polygon]} for polygon in polygons
        ]
    return [_joined(geom, solids) for geom, solids in zip(geoms, parts)]


def _joined(geom: dict, solids: dict[int, list | None]) -> dict | None:
    """A geometry with other polygons for its members, where the first of each stood."""
    if any(made is None for made in solids.values()):
        return None
    parts, done = [], set()
    for p in geom["parts"]:
        if p["kind"] != "polygon":
            parts.append(p)
        elif p["member"] not in done:
            done.add(p["member"])
            parts += solids[p["member"]]
    kind = geom["kind"]
    if kind in ("polygon", "multipolygon"):
        kind = "polygon" if len(parts) == 1 else "multipolygon"
    return {"kind": kind, "parts": parts, "srid": geom["srid"]}


@F.arrow_udf(EXAMINED)
def _examined(geom: pa.Array, _: pa.Array) -> pa.Array:
    reasons = _reasons(geom)
    fixed: list[dict | None] = [None] * len(reasons)
    faulty = [k for k, reason in enumerate(reasons) if reason in s.REASONS[s.CROSSED :]]
    for k, made in zip(faulty, mended(geom.take(pa.array(faulty, pa.int64())).to_pylist())):
        fixed[k] = made
    made = pa.array(fixed, _GEOMETRY)
    still = s.faults(s.Shapes(made)) != s.NONE
    return pa.StructArray.from_arrays([pa.array(reasons, pa.string()), pa.array([None if bad else f for f, bad in zip(fixed, still)], _GEOMETRY)], names=["reason", "fixed"])


def intersects(a: Column, b: Column) -> Column:
    """The geometries share a point; false where one is missing."""
    return _intersects(a, b, a["srid"], b["srid"])


def overlap_sqm(a: Column, b: Column) -> Column:
    """Area common to two polygon geometries, concave shapes and holes included."""
    return _overlap(a, b, a["srid"], b["srid"])


def length_m(geom: Column) -> Column:
    """Length of the line parts in metres, each edge the shortest line on the ellipsoid."""
    return _length(geom, geom["srid"])


def distance_m(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Metres between two positions in degrees on the ellipsoid, the short way round; NULL beyond a pole."""
    return _distance(x1, y1, x2, y2)


def validity(geom: Column) -> Column:
    """``struct(valid, reason)``: one of ``shapes.REASONS`` or NULL. Rings and parts may touch each other in points."""
    return _validity(geom, geom["srid"])


def examined(geom: Column) -> Column:
    """``struct(reason, fixed)``: what is wrong with the polygons, and a valid geometry made of their rings, if that can be done."""
    return _examined(geom, geom["srid"])
