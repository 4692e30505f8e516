"""Repair of polygons, points on surfaces, polygons from lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosync.functions import geom as g
from geosync.functions import planar
from geosync.functions.text import let


def make_valid(df: DataFrame, geom: str, out: str = "geom", status: str = "geom_status") -> DataFrame:
    """Adds the repaired geometry and its status: ``valid``, ``cleaned``, ``repaired`` or ``unrepaired``.

    Rings that are open, repeat vertices or have too few of them are cleaned. Polygons that are still not valid are made anew
    from all their rings, by the even-odd rule. Rows that cannot be repaired keep their geometry and their mark; none is dropped.
    """
    step = df.withColumn("_clean", g.clean(F.col(geom))).withColumn("_seen", planar.examined(F.col("_clean")))
    faulty = F.col("_seen.reason").isNotNull() & (F.col("_seen.reason") != "empty")
    mark = (
        F.when(F.col(f"{geom}.kind").isNull(), None)
        .when(faulty & F.col("_seen.fixed.kind").isNotNull(), F.lit("repaired"))
        .when(faulty, F.lit("unrepaired"))
        .when(F.col("_clean") == F.col(geom), F.lit("valid"))
        .otherwise(F.lit("cleaned"))
    )
    fixed = F.when(F.col("_seen.fixed.kind").isNotNull(), F.col("_seen.fixed")).otherwise(F.col("_clean"))
    return step.withColumn(status, mark).withColumn(out, fixed.cast(g.GEOMETRY)).drop("_clean", "_seen")


def _widest_span(p: Column) -> Column:
    """Widest inner span of a polygon part at half its height, as ``struct(width, x, y)``."""

    def mid_height(edges: Column) -> Column:
        ys = F.flatten(F.transform(edges, lambda e: F.array(e["y1"], e["y2"])))
        return let(ys, lambda v: (F.array_min(v) + F.array_max(v)) / 2)

    def hits(edges: Column, y: Column) -> Column:
        met = F.filter(edges, lambda e: (e["y1"] > y) != (e["y2"] > y))
        return F.array_sort(
            F.transform(met, lambda e: (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])
        )

    def widest(xs: Column, y: Column) -> Column:
        return F.array_max(
            F.transform(
                F.sequence(F.lit(0), F.size(xs) - 2, F.lit(2)),
                lambda i: F.struct(
                    (F.get(xs, i + 1) - F.get(xs, i)).alias("width"),
                    ((F.get(xs, i + 1) + F.get(xs, i)) / 2).alias("x"),
                    y.alias("y"),
                ),
            )
        )

    return let(
        g.part_edges(p),
        lambda edges: let(
            mid_height(edges),
            lambda y: let(hits(edges, y), lambda xs: F.when(F.size(xs) >= 2, widest(xs, y))),
        ),
    )


def point_on_surface(geom: Column) -> Column:
    """Point surely on the geometry: middle of the widest inner span at half height of a polygon,
    else the vertex nearest to the centroid."""

    def nearest(middle: Column) -> Column:
        return F.array_min(
            F.transform(
                g.vertices(geom),
                lambda v: F.struct(
                    (
                        (v["x"] - middle["x"]) * (v["x"] - middle["x"])
                        + (v["y"] - middle["y"]) * (v["y"] - middle["y"])
                    ).alias("width"),
                    v["x"].alias("x"),
                    v["y"].alias("y"),
                ),
            )
        )

    solids = F.filter(geom["parts"], lambda p: p["kind"] == "polygon")
    chosen = F.when(F.size(solids) > 0, F.array_max(F.transform(solids, _widest_span))).otherwise(
        let(g.centroid(geom), nearest)
    )
    return let(chosen, lambda v: g.point(v["x"], v["y"]))


def line_to_polygon(df: DataFrame, geom: str, out: str = "polygon", threshold: float = g.CLOSE_RATIO) -> DataFrame:
    """Adds the polygon of a closed or nearly closed line, NULL when there is none.

    The largest valid polygon of the ring counts, if it has the least area.
    """
    step = df.withColumn("_ring", g.candidate_ring(F.col(geom), threshold)).withColumn(
        "_solid", F.when(F.col("_ring").isNotNull(), g.polygon(F.col("_ring")))
    )
    step = make_valid(step, "_solid", "_valid", "_mark")
    step = step.withColumn("_best", g.largest_part(F.col("_valid"))).withColumn(
        "_area", g.area_sqm(F.col("_best"))
    )
    good = (F.col("_area") >= g.MIN_AREA_SQM) & F.col("_mark").isin("valid", "cleaned", "repaired")
    return step.withColumn(out, F.when(good, F.col("_best")).cast(g.GEOMETRY)).drop(
        "_ring", "_solid", "_valid", "_mark", "_best", "_area"
    )
