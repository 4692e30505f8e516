import math
import random

import pytest
from pyspark.sql import functions as F

from geosync.functions import geom as g
from geosync.functions import planar, repair, wkb
from geosync.functions.reproject import LOCAL_SRID, reproject
from geosync.operators import layers, spatial

METRE = 1 / 111_320


def square(gap_m: float, side_m: float = 100, close: bool = False) -> str:
    x, y, s = 37.6, 55.75, side_m * METRE
    w = s / math.cos(math.radians(y))
    ring = [(x, y), (x + w, y), (x + w, y + s), (x, y + s), (x, y if close else y + gap_m * METRE)]
    return "LINESTRING (" + ", ".join(f"{a:.12f} {b:.12f}" for a, b in ring) + ")"


def shapes(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, wkt string")
    return df.withColumn("geom", g.from_wkt(F.col("wkt")))


def column(df, expr):
    return [r["x"] for r in df.select("id", expr.alias("x")).orderBy("id").collect()]


def test_lines_to_polygons(spark):
    x, y, s = 37.6, 55.75, 100 * METRE
    multi = f"MULTILINESTRING (({x} {y}, {x + s} {y}, {x + s} {y + s}), ({x + s} {y + s}, {x} {y + s}, {x} {y + 2 * METRE}))"
    texts = [square(0, close=True), square(2), square(60), "LINESTRING (37 55, 38 56)", multi, square(0, 0.5, True), "POINT (1 2)"]
    made = repair.line_to_polygon(shapes(spark, texts), "geom", "p")
    rows = made.select("id", F.col("p.kind").alias("kind"), g.area_sqm(F.col("p")).alias("a")).orderBy("id").collect()
    assert [r["kind"] for r in rows] == ["polygon", "polygon", None, None, "polygon", None, None]
    assert rows[0]["a"] == pytest.approx(10_000, rel=0.01)


def test_collections_flatten_in_order(spark):
    texts = [
        "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (0 0, 1 1))",
        "GEOMETRYCOLLECTION (POINT (1 2), GEOMETRYCOLLECTION (LINESTRING (0 0, 1 1), GEOMETRYCOLLECTION (POLYGON ((0 0, 1 0, 1 1, 0 0)))))",
        "GEOMETRYCOLLECTION (MULTILINESTRING ((0 0, 1 1), (2 2, 3 3)), POINT (5 5))", "POLYGON EMPTY", "POLYGON ((0 0, 1", "CIRCLE (1 2)",
    ]
    df = shapes(spark, texts)
    kinds = column(df, F.transform(F.col("geom.parts"), lambda p: p["kind"]))
    assert kinds == [["point", "linestring"], ["point", "linestring", "polygon"], ["linestring", "linestring", "point"], [], None, None]
    members = column(df, F.transform(g.member_geometries(F.col("geom")), lambda m: m["kind"]))
    assert members[2] == ["multilinestring", "point"]


def test_text_and_binary_forms_agree(spark):
    texts = ["POINT (1 2)", "LINESTRING (0 0, 1.5 -1e-7)", "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 1.5, 1 1))", "MULTIPOINT (1 2, 3 4)",
             "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))", "GEOMETRYCOLLECTION (POINT (1 2), MULTILINESTRING ((0 0, 1 1), (2 2, 3 3)))", "POINT EMPTY", "POLYGON EMPTY"]
    df = shapes(spark, texts).withColumn("blob", wkb.to_ewkb(F.col("geom"))).withColumn("back", wkb.from_ewkb(F.col("blob")))
    assert all(column(df, F.col("back") == F.col("geom")))
    assert all(column(df, g.from_geojson(g.to_geojson(F.col("geom"))) == F.col("geom")))
    head = column(df, F.hex("blob"))[0]
    assert head == "0101000020E6100000000000000000F03F0000000000000040"
    assert len(set(column(df, g.geom_hash(F.col("geom"))))) == len(texts)


def test_repair(spark):
    texts = ["POLYGON ((0 0, 4 4, 4 0, 0 4, 0 0))", "POLYGON ((0 0, 4 0, 4 0, 4 4, 0 4, 0 0))", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))",
             "POLYGON ((0 0, 4 0, 2 0, 4 4, 0 4, 0 0))", "POINT (1 1)"]
    fixed = repair.make_valid(shapes(spark, texts), "geom", "fixed")
    rows = fixed.select("id", "geom_status", F.size("fixed.parts").alias("n"), planar.validity(F.col("fixed"))["valid"].alias("ok")).orderBy("id").collect()
    assert [r["geom_status"] for r in rows][:3] == ["repaired", "cleaned", "valid"]
    assert rows[0]["n"] == 2 and rows[0]["ok"] and rows[4]["geom_status"] == "valid"
    assert rows[3]["geom_status"] == "repaired" and rows[3]["ok"] and len(rows) == len(texts)


def test_repair_of_holes_and_parts(spark):
    square = "(0 0, 10 0, 10 10, 0 10, 0 0)"
    texts = [f"POLYGON ({square}, (8 3, 14 3, 14 6, 8 6, 8 3))", f"MULTIPOLYGON (({square}), ((5 5, 15 5, 15 15, 5 15, 5 5)))",
             "POLYGON ((0 0, 10 10, 10 0, 0 10, 0 0), (1 4, 2 4, 2 6, 1 6, 1 4))", "POLYGON ((0 0, 4 0, 2 0, 0 0))",
             f"GEOMETRYCOLLECTION (POINT (1 2), POLYGON ({square}, (20 3, 24 3, 24 6, 20 6, 20 3)), LINESTRING (0 0, 1 1))",
             f"POLYGON ({square}, (2 2, 2 4, 4 4, 4 2, 2 2))"]
    fixed = repair.make_valid(shapes(spark, texts), "geom", "fixed")
    rows = fixed.select("geom_status", "fixed.kind", F.size("fixed.parts").alias("n"), planar.validity(F.col("fixed"))["valid"].alias("ok")).orderBy("id").collect()
    assert [r["geom_status"] for r in rows] == ["repaired", "repaired", "repaired", "unrepaired", "repaired", "valid"]
    assert [r["ok"] for r in rows] == [True, True, True, False, True, True]
    assert [r["kind"] for r in rows][4] == "geometrycollection" and rows[4]["n"] == 4
    made = repair.line_to_polygon(shapes(spark, ["LINESTRING (37 55, 37.01 55.01, 37.01 55, 37 55.01, 37 55)"]), "geom", "p")
    assert column(made, F.size("p.parts")) == [1]


def test_area_counts_holes_out(spark):
    df = shapes(spark, ["POLYGON ((37 55, 37.1 55, 37.1 55.1, 37 55.1, 37 55), (37.02 55.02, 37.04 55.02, 37.04 55.04, 37.02 55.04, 37.02 55.02))",
                        "POLYGON ((37 55, 37.1 55, 37.1 55.1, 37 55.1, 37 55))", "POLYGON ((37.02 55.02, 37.04 55.02, 37.04 55.04, 37.02 55.04, 37.02 55.02))"])
    a, whole, hole = column(df, g.area_sqm(F.col("geom")))
    assert a == pytest.approx(whole - hole)
    # 0.1 by 0.1 degrees at 55 north: 6.39 km by 11.13 km.
    assert whole == pytest.approx(71.1e6, rel=0.01)


def test_overlap_of_concave_shapes(spark):
    notched = "POLYGON ((37 55, 37.2 55, 37.2 55.1, 37.1 55.1, 37.1 55.2, 37 55.2, 37 55))"
    turned = "POLYGON ((37 55, 37 55.2, 37.2 55.2, 37.2 55, 37 55))"
    quarter = "POLYGON ((37.1 55.1, 37.2 55.1, 37.2 55.2, 37.1 55.2, 37.1 55.1))"
    diamond = "POLYGON ((37.1 54.9, 37.3 55.1, 37.1 55.3, 36.9 55.1, 37.1 54.9))"
    df = spark.createDataFrame([(notched, turned, quarter, diamond)], "a string, b string, c string, d string").select(
        *[g.from_wkt(F.col(x)).alias(x) for x in "abcd"]
    )
    got = df.select(
        planar.overlap_sqm(F.col("a"), F.col("b")).alias("ab"), g.area_sqm(F.col("a")).alias("size_a"), planar.overlap_sqm(F.col("a"), F.col("c")).alias("ac"),
        planar.overlap_sqm(F.col("b"), F.col("c")).alias("bc"), g.area_sqm(F.col("c")).alias("size_c"), planar.overlap_sqm(F.col("d"), F.col("b")).alias("db"),
        g.area_sqm(F.col("b")).alias("size_b"),
    ).first()
    assert got["ab"] == pytest.approx(got["size_a"]) and got["ac"] == pytest.approx(0, abs=1e-3)
    assert got["bc"] == pytest.approx(got["size_c"]) and got["db"] == pytest.approx(got["size_b"], rel=1e-6)


def test_local_grid(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1000.0, 0.0), (0.0, 1000.0), (15000.0, -20000.0)], "x double, y double").withColumn(
        "geom", reproject(g.point(F.col("x"), F.col("y"), LOCAL_SRID), LOCAL_SRID)
    )
    at = [(r["lon"], r["lat"]) for r in df.select(g.x_of(F.col("geom")).alias("lon"), g.y_of(F.col("geom")).alias("lat")).collect()]
    # The origin lies near 37.5 east, 55 2/3 north; a kilometre on the grid is a kilometre on the ground.
    assert at[0] == pytest.approx((37.5, 55.6667), abs=0.01)
    assert (at[1][0] - at[0][0]) * 111_320 * math.cos(math.radians(55.67)) == pytest.approx(1000, rel=0.005)
    assert (at[2][1] - at[0][1]) * 111_320 == pytest.approx(1000, rel=0.005)


def test_split_routes_every_part(spark):
    texts = ["POINT (1 2)", "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))", "GEOMETRYCOLLECTION (POINT (1 2), POLYGON ((0 0, 4 0, 4 4, 0 0)))", "POLYGON EMPTY", "GEOMETRYCOLLECTION EMPTY", "POINT (9 9)"]
    table = shapes(spark, texts).withColumn("tasked", F.col("id") == 5).withColumn("derived_from_id", F.lit(None).cast("long"))
    split = layers.split_layers(table.drop("wkt"))
    got = [(r["source_id"], r["layer"]) for r in split.orderBy("source_id", "part_no").collect()]
    assert got == [(0, "points"), (1, "lines"), (2, "points"), (2, "polygons"), (3, None), (4, None)]
    counts = layers.split_counts(split).first()
    assert (counts["points"], counts["lines"], counts["polygons"], counts["collection_parts"], counts["skipped"]) == (2, 1, 1, 2, 2)


def inside(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


@pytest.mark.parametrize("limit,sent", [(50_000, spatial.SENT), (50_000, 0), (3, 0)])
def test_grid_join_equals_brute_force(spark, limit, sent):
    rng = random.Random(7)
    # A third of the points sit in one cell.
    points = [(i, rng.random() * 0.01, rng.random() * 0.01) if i % 3 == 0 else (i, rng.random(), rng.random()) for i in range(600)]
    stars = []
    for k in range(12):
        cx, cy, n = rng.random(), rng.random(), rng.randint(5, 9)
        stars.append((k, [(cx + math.cos(2 * math.pi * j / n) * (0.1 + 0.2 * (j % 2)), cy + math.sin(2 * math.pi * j / n) * (0.1 + 0.2 * (j % 2))) for j in range(n)]))
    left = spark.createDataFrame(points, "id int, x double, y double").withColumn("geom", g.point(F.col("x"), F.col("y")))
    texts = [(k, "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + "))") for k, ring in stars]
    right = spark.createDataFrame(texts, "gid int, wkt string").withColumn("geom", g.from_wkt(F.col("wkt")))
    pairs = spatial.spatial_join(left, right, "id", "gid", cell=0.07, hot_rows=limit, sent=sent).collect()
    wanted = {(i, k) for i, x, y in points for k, ring in stars if inside(x, y, ring)}
    assert len(pairs) == len(wanted) and {tuple(p) for p in pairs} == wanted


def test_shapes_meet_by_edges_and_containment(spark):
    pairs = [("LINESTRING (-1 1, 5 1)", True), ("LINESTRING (5 5, 6 6)", False), ("POLYGON ((1 1, 2 1, 2 2, 1 2, 1 1))", True),
             ("POLYGON ((-9 -9, 9 -9, 9 9, -9 9, -9 -9))", True), ("POINT (0 2)", True), ("POINT (4.1 2)", False), ("MULTIPOINT (9 9, 1 1)", True)]
    df = shapes(spark, [p for p, _ in pairs]).withColumn("area", g.from_wkt(F.lit("POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))")))
    assert column(df, planar.intersects(F.col("geom"), F.col("area"))) == [w for _, w in pairs]
    assert column(df.filter("id = 4"), g.point_within(g.start_point(F.col("geom")), F.col("area"))) == [False]
