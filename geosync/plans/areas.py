"""Area jobs: keys of the areas items meet, quarterly numbers, repair of double numbers, re-activation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosync.functions import geom as g
from geosync.functions.text import blank_to_null, is_distinct, normalize_label, split_number
from geosync.operators import audit, guards, merge, numbering, spatial
from geosync.session import cut_lineage

CENTROID_DECIMALS = 9


def refresh_area_keys(items: DataFrame, geometries: DataFrame, areas: DataFrame, cell: float = 0.05) -> DataFrame:
    """Items with ``area_key`` recomputed from one geometry each (``task_key``, ``geom``).

    Items without a geometry lose their keys; ``action`` tells which items changed.
    """
    keys = spatial.area_keys(geometries, areas.select(F.col("key").alias("area_key"), "geom"), cell=cell)
    joined = items.join(keys.select(F.col("task_key").alias("_key"), "area_keys"), F.col("key") == F.col("_key"), "left")
    changed = is_distinct(F.col("area_key"), F.col("area_keys"))
    return joined.select(
        *[F.col(c) for c in items.columns if c != "area_key"],
        F.col("area_keys").alias("area_key"),
        F.when(changed, F.lit("update")).otherwise(F.lit("keep")).alias("action"),
    )


def refresh_snapshots(snapshots: DataFrame, items: DataFrame) -> DataFrame:
    """Snapshot rows with the area keys of their item; ``action`` tells which rows changed."""
    parent = items.select(F.col("key").alias("task_key"), "area_key")
    return merge.update_from(
        snapshots, parent, ["task_key"], ["area_key"], is_distinct(F.col("t.area_key"), F.col("s.area_key"))
    )


def attribute_areas(areas: DataFrame, districts: DataFrame, cell: float = 0.05) -> DataFrame:
    """Labels of each area: of the district that covers it, else its own; with centroid height and size."""
    located = areas.filter(F.col("geom").isNotNull())
    cover = spatial.best_cover(located, districts, "key", "gid", cell=cell)
    named = districts.select(
        "gid",
        F.coalesce(blank_to_null(F.col("okrug_shor")), blank_to_null(F.col("okrug"))).alias("_okrug"),
        blank_to_null(F.col("rayon")).alias("_rayon"),
    )
    joined = located.join(cover, "key").join(named, "gid", "left")
    okrug = F.coalesce("_okrug", blank_to_null(F.col("okrug_shor")), blank_to_null(F.col("okrug")))
    rayon = F.coalesce("_rayon", blank_to_null(F.col("rayon")))
    return joined.select(
        "key",
        F.col("gid").isNotNull().alias("in_district"),
        normalize_label(okrug).alias("okrug_label"),
        normalize_label(rayon).alias("rayon_label"),
        F.round(g.centroid(F.col("geom"))["y"], CENTROID_DECIMALS).alias("centroid_y"),
        F.round(g.area_sqm(F.col("geom")), 1).alias("area_sqm"),
    )


def number_areas(areas: DataFrame, districts: DataFrame, as_of: Column, cell: float = 0.05) -> DataFrame:
    """``key``, ``task_number`` and ``area_sqm`` of the areas that have both labels, numbered from the north."""
    # The spatial work is done once; numbering reads its result more than once.
    labelled = cut_lineage(
        attribute_areas(areas, districts, cell).filter("okrug_label IS NOT NULL AND rayon_label IS NOT NULL")
    )
    numbered = numbering.number_rows(
        labelled, ["okrug_label", "rayon_label"], [F.col("centroid_y").desc(), F.col("key").asc()], "n"
    )
    number = F.format_string(
        "М/%s-%s-%d/%s-%d", "okrug_label", F.date_format(as_of, "yy"), F.quarter(as_of), "rayon_label", "n"
    )
    return numbered.select("key", number.alias("task_number"), "area_sqm")


def number_areas_job(areas: DataFrame, districts: DataFrame, as_of: Column, cell: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """Areas with new numbers and sizes, and the report of those left without a number.

    Areas without labels keep their old number.
    """
    numbered = cut_lineage(number_areas(areas, districts, as_of, cell))
    fresh = numbered.select("key", "task_number", F.col("area_sqm").alias("area"))
    updated = merge.update_from(areas, fresh, ["key"], ["task_number", "area"]).drop("action")
    nameless = updated.filter(F.col("geom").isNotNull() & (F.coalesce(F.trim("task_number"), F.lit("")) == ""))
    return updated, audit.first_keys(nameless, "key")


def repair_numbers(areas: DataFrame, districts: DataFrame, cell: float = 0.05) -> DataFrame:
    """Areas with double numbers resolved; ``action`` tells the renumbered ones.

    Of several areas with one number the finished, covered, northern one keeps it; the others get the
    next free numbers under the same prefix.
    """
    split = split_number(F.col("task_number"))
    used = areas.filter(F.trim("task_number") != "").withColumn("_split", split)
    doubled = audit.duplicates(used, ["task_number"]).select("task_number")
    cover = spatial.best_cover(areas.filter(F.col("geom").isNotNull()), districts, "key", "gid", cell=cell)
    state = F.when(F.col("status") == "done", 0).when(F.col("status") == "wip", 1).otherwise(2)
    candidates = used.join(doubled, "task_number").join(cover, "key", "left").select(
        "key", "task_number", F.col("_split.prefix").alias("prefix"), state.alias("state"),
        F.when(F.col("gid").isNotNull(), 0).otherwise(1).alias("outside"),
        F.round(g.centroid(F.col("geom"))["y"], CENTROID_DECIMALS).alias("north"),
    )
    ranked = numbering.number_rows(
        cut_lineage(candidates), ["task_number"],
        [F.col("state").asc(), F.col("outside").asc(), F.col("north").desc_nulls_last(), F.col("key").asc()],
        "keep_rn",
    )
    losers = numbering.number_rows(
        ranked.filter("keep_rn > 1").select("key", "prefix", "keep_rn"), ["prefix"],
        [F.col("keep_rn").asc(), F.col("key").asc()], "seq",
    )
    kept = used.join(losers.select("key"), "key", "left_anti").select(
        F.col("_split.prefix").alias("prefix"), F.col("_split.n").alias("n")
    ).filter("n IS NOT NULL")
    made = numbering.allocate_free(losers, kept).select(
        "key", F.concat_ws("-", "prefix", "new_n").alias("task_number")
    )
    return merge.update_from(areas, made, ["key"], ["task_number"])


def reactivate(pattern: str, items: DataFrame, geometries: DataFrame, districts: DataFrame, snapshots: DataFrame,
               cell: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """Snapshots without the items of the one district whose name contains ``pattern``, and the report.

    Items are found by the district name on their snapshots or by their geometry. Writing the first
    frame applies the change; the report alone is the dry run. Raises unless exactly one district fits.
    """
    found = districts.filter(F.lower("rayon").contains(pattern.lower()))
    if found.limit(2).count() != 1:
        raise ValueError(f"expected exactly one district for {pattern!r}")
    by_name = snapshots.filter(F.lower("rayon").contains(pattern.lower())).select("task_key")
    by_place = spatial.spatial_join(geometries, found, "task_key", "gid", cell=cell).select("task_key")
    keys = by_name.unionByName(by_place).filter("task_key IS NOT NULL").distinct()
    return guards.clear_snapshots(snapshots, keys, items)

