"""Polygons derived from lines, and the split of mixed geometries into layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosync.functions import geom as g
from geosync.functions import repair
from geosync.functions.text import is_not_true


def derive_polygons(table: DataFrame, threshold: float = g.CLOSE_RATIO) -> DataFrame:
    """Tags ``derived`` or ``skipped`` every line, or line member of a collection, of a feature table.

    Frozen rows, derived rows and rows that already have a derived polygon are left out. A derived
    row carries its parent's attributes, the polygon as ``geom`` and the parent in ``derived_from_id``.
    """
    done = table.filter(F.col("derived_from_id").isNotNull()).select(F.col("derived_from_id").alias("_done"))
    lines = table.filter(
        F.col("geom").isNotNull()
        & F.col("derived_from_id").isNull()
        & is_not_true(F.col("tasked"))
        & F.col("geom.kind").isin("linestring", "multilinestring", "geometrycollection")
    ).join(done.distinct(), F.col("id") == F.col("_done"), "left_anti")
    members = lines.select("*", F.posexplode(g.member_geometries(F.col("geom"))).alias("_pos", "_member")).filter(
        F.col("_member.kind").isin("linestring", "multilinestring")
    )
    tried = repair.line_to_polygon(members, "_member", "_polygon", threshold)
    outcome = F.when(F.col("_polygon").isNotNull(), F.lit("derived")).otherwise(F.lit("skipped"))
    return tried.select(
        *[c for c in table.columns if c not in ("id", "geom", "derived_from_id")],
        F.col("id").alias("derived_from_id"),
        F.col("_pos").alias("part_no"),
        F.col("_polygon").alias("geom"),
        outcome.alias("outcome"),
    )


def split_layers(table: DataFrame) -> DataFrame:
    """One row per routed geometry: ``layer``, ``source_id``, ``part_no`` and the attributes.

    Simple and multi geometries keep whole, collections give one row per simple part and no
    ``derived_from_id``. Rows that cannot be routed come back with a NULL ``layer``, those without a
    geometry with a NULL ``geom_status`` besides; frozen parents are left out.
    """
    # No filter on the geometry: Spark would push it below the parsing and parse every row twice.
    open_rows = table.filter(is_not_true(F.col("tasked")))
    fixed = repair.make_valid(open_rows, "geom", "_valid", "geom_status")
    is_collection = F.col("_valid.kind") == "geometrycollection"
    # An empty geometry keeps one row without a layer, to be counted as skipped.
    pieces = F.when(is_collection, g.dump(F.col("_valid"))).otherwise(F.array(F.col("_valid")))
    attributes = [
        c for c in table.columns if c not in ("id", "geom", "tasked", "derived_from_id", "task_key")
    ]
    routed = fixed.select(
        *attributes,
        F.col("id").alias("source_id"),
        F.when(is_collection, None).otherwise(F.col("derived_from_id")).alias("derived_from_id"),
        is_collection.alias("from_collection"),
        "geom_status",
        F.posexplode_outer(pieces).alias("part_no", "geom"),
    )
    layer = F.when(~g.is_empty(F.col("geom")), g.layer_of(F.col("geom")))
    return routed.withColumn("layer", layer)


def split_counts(split: DataFrame) -> DataFrame:
    """One row: parts per layer, derived polygons, collections, their parts, and skipped rows."""
    routed = F.col("layer").isNotNull()
    return split.agg(
        F.count_if(F.col("layer") == "points").alias("points"),
        F.count_if(F.col("layer") == "lines").alias("lines"),
        F.count_if(F.col("layer") == "polygons").alias("polygons"),
        F.count_if((F.col("layer") == "polygons") & F.col("derived_from_id").isNotNull()).alias("derived"),
        F.count_if(F.col("from_collection") & (F.coalesce(F.col("part_no"), F.lit(0)) == 0)).alias("collection_rows"),
        F.count_if(F.col("from_collection") & routed).alias("collection_parts"),
        F.count_if(~routed & F.col("geom_status").isNotNull()).alias("skipped"),
    )
