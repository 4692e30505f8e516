"""Geometry columns: constructors, GeoJSON and WKT, measures, predicates, repair.

A geometry is a struct of its kind, its simple parts and its SRID. Collections are flattened when
parsed: ``member`` tells which member of the collection a part came from. Rings are vertex arrays;
a polygon's first ring is its shell. Every function here is a Spark expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from geosync.functions.text import let

VERTEX = "struct<x:double,y:double>"
RINGS = f"array<array<{VERTEX}>>"
PART = f"struct<kind:string,member:int,rings:{RINGS}>"
GEOMETRY = f"struct<kind:string,parts:array<{PART}>,srid:int>"
EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"

# WGS84 ellipsoid, same-vertex tolerance, decimals that tell vertices apart, least area.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
SAME_VERTEX = 1e-12
VERTEX_DECIMALS = 9
MIN_AREA_SQM = 1.0
CLOSE_RATIO = 0.1

_E2 = WGS84_F * (2 - WGS84_F)
_E = math.sqrt(_E2)
_RAD = math.pi / 180.0


# --- constructors and access -------------------------------------------------------------------


def vertex(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def part(kind: str, rings: Column, member: int = 0) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), F.lit(member).cast("int").alias("member"), rings.alias("rings")
    )


def geometry(kind: Column | str, parts: Column, srid: int = 4326) -> Column:
    name = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(name.alias("kind"), parts.alias("parts"), F.lit(srid).alias("srid")).cast(GEOMETRY)


def point(x: Column, y: Column, srid: int = 4326) -> Column:
    """Point, or NULL when a coordinate is missing."""
    made = geometry("point", F.array(part("point", F.array(F.array(vertex(x, y))))), srid)
    return F.when(x.isNotNull() & y.isNotNull(), made)


def lonlat_point(lat: Column, lng: Column) -> Column:
    """Point from a coordinate pair; NULL outside the valid range."""
    ok = lat.between(-90, 90) & lng.between(-180, 180)
    return F.when(ok, point(lng, lat))


def linestring(vertices: Column, srid: int = 4326) -> Column:
    return geometry("linestring", F.array(part("linestring", F.array(vertices))), srid)


def polygon(*rings: Column, srid: int = 4326) -> Column:
    return geometry("polygon", F.array(part("polygon", F.array(*rings))), srid)


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(vertex(x0, y0), vertex(x1, y0), vertex(x1, y1), vertex(x0, y1), vertex(x0, y0))


def vertices(geom: Column) -> Column:
    """Every vertex in order."""
    return F.flatten(F.flatten(F.transform(geom["parts"], lambda p: p["rings"])))


def x_of(geom: Column) -> Column:
    return F.get(vertices(geom), F.lit(0))["x"]


def y_of(geom: Column) -> Column:
    return F.get(vertices(geom), F.lit(0))["y"]


def is_empty(geom: Column) -> Column:
    return geom.isNull() | (F.coalesce(F.size(vertices(geom)), F.lit(0)) <= 0)


def n_points(geom: Column) -> Column:
    return F.size(vertices(geom))


def start_point(geom: Column) -> Column:
    return F.get(vertices(geom), F.lit(0))


def end_point(geom: Column) -> Column:
    return F.try_element_at(vertices(geom), F.lit(-1))


def layer_of(geom: Column) -> Column:
    """``points``, ``lines`` or ``polygons``; NULL for a collection or anything else."""
    kind = F.replace(geom["kind"], F.lit("multi"), F.lit(""))
    return (
        F.when(kind == "point", F.lit("points"))
        .when(kind == "linestring", F.lit("lines"))
        .when(kind == "polygon", F.lit("polygons"))
    )


def to_multi(geom: Column) -> Column:
    """The multi form of a simple geometry; others unchanged."""
    simple = geom["kind"].isin("point", "linestring", "polygon")
    kind = F.when(simple, F.concat(F.lit("multi"), geom["kind"])).otherwise(geom["kind"])
    return F.when(
        geom.isNotNull(),
        F.struct(kind.alias("kind"), geom["parts"].alias("parts"), geom["srid"].alias("srid")),
    ).cast(GEOMETRY)


def member_geometries(geom: Column) -> Column:
    """Members of a collection as geometries, multi members kept whole; a simple geometry as itself."""

    def join(groups: Column, p: Column) -> Column:
        last = F.try_element_at(groups, F.lit(-1))
        same = (F.size(groups) > 0) & (F.get(last, F.lit(0))["member"] == p["member"])
        return F.when(
            same,
            F.concat(
                F.slice(groups, F.lit(1), F.size(groups) - 1), F.array(F.concat(last, F.array(p)))
            ),
        ).otherwise(F.concat(groups, F.array(F.array(p))))

    def gathered(own: Column) -> Column:
        kind = F.get(own, F.lit(0))["kind"]
        return F.struct(
            F.when(F.size(own) > 1, F.concat(F.lit("multi"), kind)).otherwise(kind).alias("kind"),
            own.alias("parts"),
            geom["srid"].alias("srid"),
        )

    groups = F.aggregate(geom["parts"], F.array().cast(f"array<array<{PART}>>"), join)
    return F.when(geom["kind"] == "geometrycollection", F.transform(groups, gathered)).when(
        geom.isNotNull(), F.array(geom)
    )


def dump(geom: Column) -> Column:
    """Simple parts as geometries of their own."""
    return F.transform(
        geom["parts"],
        lambda p: F.struct(p["kind"].alias("kind"), F.array(p).alias("parts"), geom["srid"].alias("srid")),
    )


# --- text forms --------------------------------------------------------------------------------


def _ring(text: Column) -> Column:
    return F.transform(
        F.from_json(text, "array<array<double>>"), lambda c: vertex(F.get(c, F.lit(0)), F.get(c, F.lit(1)))
    )


def _rings(text: Column, schema: str = "array<array<array<double>>>") -> Column:
    return F.transform(
        F.from_json(text, schema),
        lambda r: F.transform(r, lambda c: vertex(F.get(c, F.lit(0)), F.get(c, F.lit(1)))),
    )


def _leaf_parts(kind: Column, coords: Column, member: Column, shells_only: bool) -> Column:
    """Simple parts of one leaf geometry from its kind and the text of its coordinates."""

    def made(name: str, rings: Column) -> Column:
        return F.struct(F.lit(name).alias("kind"), member.alias("member"), rings.alias("rings"))

    def holes(rings: Column) -> Column:
        return F.slice(rings, 1, 1) if shells_only else rings

    def point(flat: Column) -> Column:
        single = F.array(F.array(vertex(F.get(flat, F.lit(0)), F.get(flat, F.lit(1)))))
        return F.when(F.size(flat) == 0, F.array()).when(F.size(flat) >= 2, F.array(made("point", single)))

    solids = F.from_json(coords, "array<array<array<array<double>>>>")
    return (
        F.when(kind == "point", let(F.from_json(coords, "array<double>"), point))
        .when(kind == "linestring", F.array(made("linestring", F.array(_ring(coords)))))
        .when(kind == "polygon", F.array(made("polygon", holes(_rings(coords)))))
        .when(
            kind == "multipoint",
            F.transform(_ring(coords), lambda v: made("point", F.array(F.array(v)))),
        )
        .when(
            kind == "multilinestring",
            F.transform(_rings(coords), lambda r: made("linestring", F.array(r))),
        )
        .when(
            kind == "multipolygon",
            F.transform(
                solids,
                lambda solid: made(
                    "polygon",
                    holes(
                        F.transform(
                            solid,
                            lambda r: F.transform(r, lambda c: vertex(F.get(c, F.lit(0)), F.get(c, F.lit(1)))),
                        )
                    ),
                ),
            ),
        )
    ).cast(f"array<{PART}>")


_KINDS = (
    "point", "linestring", "polygon", "multipoint", "multilinestring", "multipolygon", "geometrycollection",
)


def _assemble(kind: Column, leaves: Column, shells_only: bool, srid: int) -> Column:
    """Geometry from its kind and leaves ``struct(kind, coords)``; NULL when a leaf cannot be read."""

    def unread(ring: Column) -> Column:
        return ring.isNull() | F.exists(ring, lambda v: v["x"].isNull() | v["y"].isNull())

    def checked(per_leaf: Column) -> Column:
        broken = F.exists(
            per_leaf,
            lambda parts: parts.isNull() | F.exists(parts, lambda p: F.exists(p["rings"], unread)),
        )
        parts = F.filter(F.flatten(per_leaf), lambda p: F.exists(p["rings"], lambda r: F.size(r) > 0))
        made = F.struct(kind.alias("kind"), parts.alias("parts"), F.lit(srid).alias("srid"))
        return F.when(~F.coalesce(broken, F.lit(True)), made)

    per_leaf = F.transform(leaves, lambda leaf, i: _leaf_parts(leaf["kind"], leaf["coords"], i, shells_only))
    return F.when(kind.isin(*_KINDS), let(per_leaf, checked)).cast(GEOMETRY)


def from_geojson(text: Column, shells_only: bool = False, srid: int = 4326) -> Column:
    """Geometry from GeoJSON text, collections of any depth flattened; NULL when it cannot be read.

    ``shells_only`` drops the holes, as the exporter's fallback does.
    """

    def leaf(t: Column) -> Column:
        return F.struct(
            F.lower(F.get_json_object(t, "$.type")).alias("kind"),
            F.get_json_object(t, "$.coordinates").alias("coords"),
        )

    def read(body: Column) -> Column:
        # Leaf geometries are the objects without braces inside, at whatever depth they sit.
        inner = F.transform(F.regexp_extract_all(body, F.lit(r"\{[^{}]*\}"), F.lit(0)), leaf)
        return let(
            leaf(body),
            lambda own: _assemble(
                own["kind"],
                F.when(own["kind"] == "geometrycollection", inner).otherwise(F.array(own)),
                shells_only,
                srid,
            ),
        )

    return let(text, read)


def from_wkt(text: Column, srid: int = 4326) -> Column:
    """Geometry from WKT or EWKT text; NULL when it cannot be read."""
    number = r"(-?[0-9.]+(?:E[+-]?[0-9]+)?)"

    def leaf(token: Column) -> Column:
        name = F.lower(F.regexp_extract(token, "^([A-Z]+)", 1))
        body = F.regexp_replace(token, r"^[A-Z]+\s*Z?\s*", "")
        body = F.regexp_replace(body, rf"{number}\s+{number}(?:\s+{number})*", "[$1,$2]")
        body = F.translate(body, "()", "[]")

        def coords(v: Column) -> Column:
            return (
                F.when(v["name"] == "point", F.regexp_replace(v["body"], r"^\[\s*|\s*\]$", ""))
                .when(
                    v["name"] == "multipoint",
                    F.regexp_replace(v["body"], r"\[\s*(\[[^\[\]]*\])\s*\](?=\s*[,\]])", "$1"),
                )
                .otherwise(v["body"])
            )

        return let(
            F.struct(name.alias("name"), body.alias("body")),
            lambda v: F.struct(v["name"].alias("kind"), coords(v).alias("coords")),
        )

    pattern = r"(?:MULTI)?(?:POINT|LINESTRING|POLYGON)\s*Z?\s*\([^A-DF-Z]*\)"

    def read(upper: Column) -> Column:
        kind = F.lower(F.regexp_extract(upper, "^([A-Z]+)", 1))
        leaves = F.transform(F.regexp_extract_all(upper, F.lit(pattern), F.lit(0)), leaf)
        return let(
            F.struct(kind.alias("kind"), leaves.alias("leaves")),
            lambda v: F.when(
                (F.size(v["leaves"]) > 0) | upper.rlike(r"^[A-Z]+\s+EMPTY$"),
                _assemble(v["kind"], v["leaves"], False, srid),
            ),
        )

    return let(F.regexp_replace(F.upper(F.trim(text)), r"^SRID=\d+;\s*", ""), read)


def to_geojson(geom: Column) -> Column:
    """GeoJSON text of a geometry."""
    flat = lambda v: F.array(v["x"], v["y"])
    rings = lambda p: F.transform(p["rings"], lambda r: F.transform(r, flat))
    first = lambda p: F.get(p["rings"], F.lit(0))

    def coords(kind: Column, parts: Column) -> Column:
        head = F.get(parts, F.lit(0))
        return (
            F.when(F.size(parts) == 0, F.lit("[]"))
            .when(kind == "point", F.to_json(flat(F.get(first(head), F.lit(0)))))
            .when(kind == "linestring", F.to_json(F.transform(first(head), flat)))
            .when(kind == "polygon", F.to_json(rings(head)))
            .when(kind == "multipoint", F.to_json(F.transform(parts, lambda p: flat(F.get(first(p), F.lit(0))))))
            .when(kind == "multilinestring", F.to_json(F.transform(parts, lambda p: F.transform(first(p), flat))))
            .when(kind == "multipolygon", F.to_json(F.transform(parts, rings)))
        )

    names = F.create_map(
        *[
            F.lit(x)
            for pair in (
                ("point", "Point"), ("linestring", "LineString"), ("polygon", "Polygon"),
                ("multipoint", "MultiPoint"), ("multilinestring", "MultiLineString"),
                ("multipolygon", "MultiPolygon"), ("geometrycollection", "GeometryCollection"),
            )
            for x in pair
        ]
    )

    def simple(kind: Column, parts: Column) -> Column:
        return F.concat(
            F.lit('{"type":"'), names[kind], F.lit('","coordinates":'), coords(kind, parts), F.lit("}")
        )

    members = F.transform(member_geometries(geom), lambda m: simple(m["kind"], m["parts"]))
    return F.when(
        geom["kind"] == "geometrycollection",
        F.concat(
            F.lit('{"type":"GeometryCollection","geometries":['), F.array_join(members, ","), F.lit("]}")
        ),
    ).when(geom["kind"].isNotNull(), simple(geom["kind"], geom["parts"]))


def extract_geometry(row: Column) -> Column:
    """Geometry of a feature row: its own geometry, else the first readable one under ``Cells`` or the root.

    Text may be WKT or GeoJSON, a list may be one position or several.
    """

    def candidate(text: Column) -> Column:
        one = F.from_json(text, "array<double>")
        many = F.filter(F.from_json(text, "array<array<double>>"), lambda c: F.size(c) >= 2)
        line = F.transform(many, lambda c: vertex(F.get(c, F.lit(0)), F.get(c, F.lit(1))))
        return (
            F.when(text.startswith("{"), from_geojson(text, shells_only=True))
            .when(
                text.rlike(r"^\[\s*-?[0-9]") & (F.size(one) >= 2),
                point(F.get(one, F.lit(0)), F.get(one, F.lit(1))),
            )
            .when(
                text.rlike(r"^\[\s*\["),
                F.when(F.size(line) == 1, point(F.get(line, F.lit(0))["x"], F.get(line, F.lit(0))["y"])).when(
                    F.size(line) > 1, linestring(line)
                ),
            )
            .when(text.rlike("^[A-Za-z]"), from_wkt(text))
        )

    own = F.when(F.get_json_object(row, "$.type") == "Feature", F.get_json_object(row, "$.geometry"))
    cells = [
        F.get_json_object(row, f"$.Cells.{key}")
        for key in ("geoData", "GeoData", "geometry", "coordinates", "wkt", "geom")
    ]
    root = [
        F.get_json_object(row, f"$.{key}") for key in ("geoData", "GeoData", "geometry", "coordinates", "wkt")
    ]
    # In the order of preference; only a feature's own geometry must be GeoJSON.
    texts = F.filter(F.array(F.when(F.trim(own).startswith("{"), own), *cells, *root), lambda t: t.isNotNull())
    read = F.transform(texts, lambda t: let(F.trim(t), candidate))
    return F.get(F.filter(read, lambda made: made["kind"].isNotNull()), F.lit(0))


# --- edges and measures ------------------------------------------------------------------------


def ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs of a vertex array."""
    count = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, F.lit(1), count),
        F.slice(ring, F.lit(2), count),
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _edge_length_m(e: Column) -> Column:
    """Length of a short edge by the radii of curvature at its middle latitude."""
    mid = F.sin((e["y1"] + e["y2"]) / 2 * _RAD)
    bend = F.lit(1.0) - F.lit(_E2) * mid * mid
    meridian = F.lit(WGS84_A * (1 - _E2)) / (bend * F.sqrt(bend))
    normal = F.lit(WGS84_A) / F.sqrt(bend)
    north = meridian * (e["y2"] - e["y1"]) * _RAD
    east = normal * F.cos((e["y1"] + e["y2"]) / 2 * _RAD) * (e["x2"] - e["x1"]) * _RAD
    return F.sqrt(north * north + east * east)


def ring_length_m(ring: Column) -> Column:
    return total(F.transform(ring_edges(ring), _edge_length_m))


def distance_m(p: Column, q: Column) -> Column:
    return _edge_length_m(
        F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"))
    )


def _authalic_y(lat: Column) -> Column:
    """Height of a latitude in the cylindrical plane that keeps areas, in metres."""

    def height(s: Column) -> Column:
        q = F.lit(1 - _E2) * (
            s / (F.lit(1.0) - F.lit(_E2) * s * s)
            - F.lit(1 / (2 * _E)) * F.log((F.lit(1.0) - F.lit(_E) * s) / (F.lit(1.0) + F.lit(_E) * s))
        )
        return F.lit(WGS84_A / 2) * q

    return let(F.sin(lat * _RAD), height)


def equal_area_ring(ring: Column) -> Column:
    """Ring in the plane that keeps areas, relative to its first vertex, in metres."""
    start = F.get(ring, F.lit(0))
    return let(
        F.struct(start["x"].alias("x"), _authalic_y(start["y"]).alias("y")),
        lambda o: F.transform(
            ring,
            lambda v: F.struct(
                ((v["x"] - o["x"]) * (WGS84_A * _RAD)).alias("x"), (_authalic_y(v["y"]) - o["y"]).alias("y")
            ),
        ),
    )


def signed_area(ring: Column) -> Column:
    """Planar signed area of a ring, relative to its first vertex to keep digits."""

    def about(o: Column) -> Column:
        products = F.transform(
            ring_edges(ring),
            lambda e: (e["x1"] - o["x"]) * (e["y2"] - o["y"]) - (e["x2"] - o["x"]) * (e["y1"] - o["y"]),
        )
        return total(products) / 2

    return let(F.get(ring, F.lit(0)), about)


def _rings_area(rings: Column, measure) -> Column:
    """Shell minus holes."""
    return let(
        F.transform(rings, lambda r: F.abs(measure(r))),
        lambda areas: F.lit(2.0) * F.get(areas, F.lit(0)) - total(areas),
    )


def ring_area_sqm(ring: Column) -> Column:
    return let(equal_area_ring(ring), signed_area)


def part_area_sqm(p: Column) -> Column:
    return F.when(p["kind"] == "polygon", _rings_area(p["rings"], ring_area_sqm)).otherwise(F.lit(0.0))


def planar_area(geom: Column) -> Column:
    """Area of the polygon parts in the square of the coordinates' unit."""
    solids = F.filter(geom["parts"], lambda p: p["kind"] == "polygon")
    return total(F.transform(solids, lambda p: _rings_area(p["rings"], signed_area)))


def area_sqm(geom: Column) -> Column:
    """Area of the polygon parts on the ellipsoid, in square metres."""
    return total(F.transform(geom["parts"], part_area_sqm))


def largest_part(geom: Column) -> Column:
    """Polygon part of the largest area; the earliest one wins a tie."""
    areas = F.transform(geom["parts"], lambda p: F.when(p["kind"] == "polygon", part_area_sqm(p)))

    def pick(sizes: Column) -> Column:
        # array_position counts from one and finds the earliest.
        at = F.array_position(sizes, F.array_max(sizes)) - 1
        return F.when(
            F.array_max(sizes).isNotNull(),
            F.struct(
                F.lit("polygon").alias("kind"),
                F.array(F.get(geom["parts"], at.cast("int"))).alias("parts"),
                geom["srid"].alias("srid"),
            ),
        )

    return let(areas, pick)


def _ring_moments(edges: Column, sign: Column) -> Column:
    """Weight and first moments of a ring given as edges; ``sign`` is +1 for a shell, -1 for a hole."""
    terms = F.transform(
        edges,
        lambda e: F.struct(
            (e["x1"] * e["y2"] - e["x2"] * e["y1"]).alias("w"),
            (e["x1"] + e["x2"]).alias("x"),
            (e["y1"] + e["y2"]).alias("y"),
        ),
    )

    def moments(t: Column) -> Column:
        weight = total(F.transform(t, lambda v: v["w"]))
        turn = sign * F.signum(weight)
        return F.struct(
            (turn * weight / 2).alias("w"),
            (turn * total(F.transform(t, lambda v: v["w"] * v["x"])) / 6).alias("x"),
            (turn * total(F.transform(t, lambda v: v["w"] * v["y"])) / 6).alias("y"),
        )

    return let(terms, moments)


def _line_moment(e: Column) -> Column:
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    return let(
        F.sqrt(dx * dx + dy * dy),
        lambda size: F.struct(
            size.alias("w"),
            (size * (e["x1"] + e["x2"]) / 2).alias("x"),
            (size * (e["y1"] + e["y2"]) / 2).alias("y"),
        ),
    )


def _mean(terms: Column, origin: Column) -> Column:
    """Weighted mean position of moment terms that are relative to ``origin``; NULL without weight."""
    sums = F.aggregate(
        terms,
        F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y")),
        lambda acc, t: F.struct(
            (acc["w"] + t["w"]).alias("w"), (acc["x"] + t["x"]).alias("x"), (acc["y"] + t["y"]).alias("y")
        ),
    )
    return let(
        sums,
        lambda m: F.when(
            m["w"] > 0,
            F.struct((origin["x"] + m["x"] / m["w"]).alias("x"), (origin["y"] + m["y"] / m["w"]).alias("y")),
        ),
    )


def centroid(geom: Column) -> Column:
    """Planar centroid as ``struct(x, y)``: of the polygons, else of the lines, else of the points."""

    def about(origin: Column) -> Column:
        def moved(ring: Column) -> Column:
            return F.transform(
                ring,
                lambda v: F.struct((v["x"] - origin["x"]).alias("x"), (v["y"] - origin["y"]).alias("y")),
            )

        def of_kind(kind: str) -> Column:
            return F.filter(geom["parts"], lambda p: p["kind"] == kind)

        solid = F.flatten(
            F.transform(
                of_kind("polygon"),
                lambda p: F.transform(
                    p["rings"],
                    lambda r, i: _ring_moments(ring_edges(moved(r)), F.when(i == 0, 1.0).otherwise(-1.0)),
                ),
            )
        )
        lines = F.flatten(
            F.transform(
                of_kind("linestring"),
                lambda p: F.transform(ring_edges(moved(F.get(p["rings"], F.lit(0)))), _line_moment),
            )
        )
        dots = F.transform(
            moved(vertices(geom)), lambda v: F.struct(F.lit(1.0).alias("w"), v["x"].alias("x"), v["y"].alias("y"))
        )
        return F.coalesce(_mean(solid, origin), _mean(lines, origin), _mean(dots, origin))

    return let(F.get(vertices(geom), F.lit(0)), about)


def bbox(geom: Column) -> Column:
    """``struct(xmin, ymin, xmax, ymax)``, NULL when empty."""

    def box(every: Column) -> Column:
        xs = F.transform(every, lambda v: v["x"])
        ys = F.transform(every, lambda v: v["y"])
        return F.when(
            F.size(every) > 0,
            F.struct(
                F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"),
            ),
        )

    return let(vertices(geom), box)


def geom_hash(geom: Column) -> Column:
    """MD5 over kind, SRID and every coordinate: equal exactly for equal geometries."""
    body = F.transform(
        geom["parts"],
        lambda p: F.concat(
            p["kind"],
            F.lit("("),
            F.array_join(
                F.transform(
                    p["rings"],
                    lambda r: F.array_join(
                        F.transform(r, lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string"))),
                        ",",
                    ),
                ),
                ";",
            ),
            F.lit(")"),
        ),
    )
    text = F.concat_ws("|", geom["kind"], geom["srid"].cast("string"), F.array_join(body, ""))
    return F.when(geom["kind"].isNotNull(), F.md5(text.cast("binary")))


# --- predicates --------------------------------------------------------------------------------


def part_edges(p: Column) -> Column:
    return F.flatten(F.transform(p["rings"], ring_edges))


def cross(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def _on_edge(e: Column, x: Column, y: Column) -> Column:
    return (
        (cross(e["x1"], e["y1"], e["x2"], e["y2"], x, y) == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )


def _crossings(edges: Column, x: Column, y: Column) -> Column:
    """True when a ray from the position meets the edges an odd number of times."""
    hits = F.filter(
        edges,
        lambda e: ((e["y1"] > y) != (e["y2"] > y))
        & (x < (e["x2"] - e["x1"]) * F.try_divide(y - e["y1"], e["y2"] - e["y1"]) + e["x1"]),
    )
    return F.size(hits) % 2 == 1


def position_within(x: Column, y: Column, p: Column) -> Column:
    """Strictly inside a polygon part."""
    edges = part_edges(p)
    return _crossings(edges, x, y) & ~F.exists(edges, lambda e: _on_edge(e, x, y))


def point_within(pt: Column, geom: Column) -> Column:
    """Position ``struct(x, y)`` strictly inside one of the polygon parts."""
    return F.exists(
        geom["parts"], lambda p: (p["kind"] == "polygon") & position_within(pt["x"], pt["y"], p)
    )


# --- repair ------------------------------------------------------------------------------------


def same_vertex(a: Column, b: Column) -> Column:
    return (F.abs(a["x"] - b["x"]) < SAME_VERTEX) & (F.abs(a["y"] - b["y"]) < SAME_VERTEX)


def is_closed(ring: Column) -> Column:
    return same_vertex(F.get(ring, F.lit(0)), F.try_element_at(ring, F.lit(-1)))


def close_ring(ring: Column) -> Column:
    return F.when(is_closed(ring), ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def drop_repeats(ring: Column) -> Column:
    """Without vertices equal to the one before."""
    return F.filter(
        ring,
        lambda v, i: (i == 0) | ~same_vertex(v, F.get(ring, F.greatest(i - 1, F.lit(0)))),
    )


def clean_rings(p: Column) -> Column:
    """Part with repeated vertices dropped, rings closed, degenerate rings removed, shells turned
    counter-clockwise and holes clockwise."""

    def turned(ring: Column, i: Column) -> Column:
        return F.when((i == 0) == (signed_area(ring) > 0), ring).otherwise(F.reverse(ring))

    def kept(rings: Column) -> Column:
        return F.when(
            F.size(F.get(rings, F.lit(0))) >= 4,
            F.transform(F.filter(rings, lambda r: F.size(r) >= 4), turned),
        ).otherwise(F.array().cast(RINGS))

    closed = F.transform(p["rings"], lambda r: let(drop_repeats(r), close_ring))
    return F.struct(
        p["kind"].alias("kind"),
        p["member"].alias("member"),
        F.when(p["kind"] != "polygon", F.transform(p["rings"], drop_repeats))
        .otherwise(let(closed, kept))
        .alias("rings"),
    )


def clean(geom: Column) -> Column:
    """Geometry after the simple repairs of :func:`clean_rings`; parts left without rings go."""
    parts = F.filter(F.transform(geom["parts"], clean_rings), lambda p: F.size(p["rings"]) > 0)
    return F.when(
        geom.isNotNull(),
        F.struct(geom["kind"].alias("kind"), parts.alias("parts"), geom["srid"].alias("srid")),
    ).cast(GEOMETRY)


# --- lines to polygons -------------------------------------------------------------------------


def _distinct_vertices(ring: Column) -> Column:
    keys = F.transform(
        ring,
        lambda v: F.struct(F.round(v["x"], VERTEX_DECIMALS), F.round(v["y"], VERTEX_DECIMALS)),
    )
    return F.size(F.array_distinct(keys))


def chain(lines: Column) -> Column:
    """Vertices of the lines one after the other, a shared joint kept once."""
    return F.aggregate(
        lines,
        F.array().cast(f"array<{VERTEX}>"),
        lambda acc, line: F.when(
            (F.size(acc) > 0) & (F.size(line) > 0) & same_vertex(F.try_element_at(acc, F.lit(-1)), F.get(line, F.lit(0))),
            F.concat(acc, F.slice(line, F.lit(2), F.greatest(F.size(line) - 1, F.lit(0)))),
        ).otherwise(F.concat(acc, line)),
    )


def candidate_ring(geom: Column, threshold: float = CLOSE_RATIO) -> Column:
    """Closed ring of a line whose ends meet, or whose gap is small against its length; else NULL."""
    lines = F.transform(
        F.filter(geom["parts"], lambda p: p["kind"] == "linestring"), lambda p: F.get(p["rings"], F.lit(0))
    )

    def judged(v: Column) -> Column:
        closed_line = (geom["kind"] == "linestring") & (v["first"] == v["last"])
        near = F.try_divide(distance_m(v["first"], v["last"]), v["span"]) < threshold
        usable = (v["span"] > 0) & (closed_line | near) & (_distinct_vertices(v["joined"]) >= 3)
        return F.when(usable, let(close_ring(v["joined"]), lambda r: F.when(F.size(r) >= 4, r)))

    def described(every: Column) -> Column:
        return let(
            F.struct(
                F.get(F.get(every, F.lit(0)), F.lit(0)).alias("first"),
                F.try_element_at(F.try_element_at(every, F.lit(-1)), F.lit(-1)).alias("last"),
                total(F.transform(every, ring_length_m)).alias("span"),
                chain(every).alias("joined"),
            ),
            judged,
        )

    return F.when(
        geom["kind"].isin("linestring", "multilinestring") & (F.size(geom["parts"]) > 0),
        let(lines, described),
    )
