"""Mirrored tables: merge with reprojection, label ingest, layers replaced by key, schema copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geosync.functions import geom as g
from geosync.functions.repair import point_on_surface
from geosync.functions.reproject import LOCAL_SRID, reproject
from geosync.functions.text import match_any, strip_to_null
from geosync.operators import audit, merge, purge
from geosync.operators.keep import last_wins
from geosync.plans.items import sync_photo_items
from geosync.session import cut_lineage
from geosync.sources.geojson import typed_features
from geosync.sources.tables import missing_keys, read_by_keys, read_incremental, sync_schema

# Words that mark a label by containment, and labels taken as they are.
KEYWORDS = (
    "РАЗР", "НАВАЛ", "НАВ.", "ЗАВАЛ", "ЗАВ.", "М.С.", "ЗЕМЛ.РАБ.", "ИЗРЫТО", "РЕКОНСТРУКЦИЯ", "РЕК-ЦИЯ", "ЯМА",
)
LABELS = (
    "РАЗР", "НАВАЛ", "РАЗР.", "НАВ.", "ЗАВАЛ", "ЗАВАЛЕНО", "ЗАВ.", "М.С.", "ЗЕМЛ.РАБ.", "ИЗРЫТО",
    "РЕКОНСТРУКЦИЯ", "РЕКОНСТР.", "РЕК-ЦИЯ", "ЯМА",
)
BOOTSTRAP = 50


def mirror_job(source: DataFrame, target: DataFrame, key: str, compare: list[str], orders: DataFrame | None = None,
               order_column: str = "order_name", srid: int = LOCAL_SRID) -> dict[str, DataFrame]:
    """Target brought in line with the source, geometries reprojected and made multi.

    With a list of ``orders`` only those rows are read, nothing is deleted, and orders not found are
    reported.
    """
    partial = source if orders is None else read_by_keys(source, order_column, orders)
    moved = partial.withColumn("geom", g.to_multi(reproject(F.col("geom"), srid)))
    tagged = cut_lineage(merge.mirror(target, cut_lineage(moved), key, compare, delete_missing=orders is None))
    result = {"table": merge.settle(tagged), "counts": merge.count_actions(tagged)}
    if orders is not None:
        result["missing"] = missing_keys(orders, partial, order_column)
    return result


def by_keyword(label: Column) -> Column:
    return match_any(label, KEYWORDS)


def by_list(label: Column) -> Column:
    return F.trim(label).isin(*LABELS)


def ingest_labels(source: DataFrame, target: DataFrame, tag: str, wanted: Column | None, as_of: Column,
                  srid: int = LOCAL_SRID, bootstrap: int = BOOTSTRAP) -> dict[str, DataFrame]:
    """New labels (``fid``, ``label``, ``number``, ``geom``) upserted as points by number and place.

    Reads above the highest ``fid`` under ``tag``; the first run takes the newest ``bootstrap`` rows.
    Incomplete rows and rows without a point come back as ``rejects``.
    """
    last = audit.high_water(target, "source_fid", F.col("filter_pass") == tag).first()["high_water"]
    chosen = source if wanted is None else source.filter(wanted)
    complete = (
        strip_to_null(F.col("label")).isNotNull()
        & strip_to_null(F.col("number").cast("string")).isNotNull()
        & F.col("geom").isNotNull()
    )
    judged = chosen.withColumn("_ok", F.coalesce(complete, F.lit(False)))
    fetched = cut_lineage(read_incremental(judged.filter("_ok"), "fid", last, bootstrap))
    placed = fetched.withColumn("_moved", reproject(F.col("geom"), srid)).withColumn(
        "geometry", point_on_surface(F.col("_moved"))
    )
    rows = cut_lineage(
        placed.select(
            "fid",
            strip_to_null(F.col("label")).alias("label_text"),
            F.lit(tag).alias("filter_pass"),
            strip_to_null(F.col("number").cast("string")).alias("source_json"),
            g.x_of(F.col("geometry")).alias("lon"),
            g.y_of(F.col("geometry")).alias("lat"),
            "geometry",
            F.col("fid").cast("long").alias("source_fid"),
            as_of.cast("timestamp").alias("loaded_at"),
        )
    )
    good = rows.filter("lon IS NOT NULL")
    tagged = cut_lineage(merge.upsert(target, good.drop("fid"), ["source_json", "lon", "lat"], [F.col("source_fid")]))
    rejects = judged.filter(~F.col("_ok")).select("fid", F.lit("incomplete").alias("reason")).unionByName(
        rows.filter("lon IS NULL").select("fid", F.lit("no point").alias("reason"))
    )
    return {"table": merge.settle(tagged), "counts": merge.count_actions(tagged), "rejects": rejects}


def replace_by_key(features: DataFrame, key: str, order: str = "ord") -> dict[str, DataFrame]:
    """Layer rebuilt from features, the last feature per key winning, expired states purged.

    Types are inferred anew. Features without a key are left out and counted.
    """
    typed, types = typed_features(features)
    if key not in dict(types):
        raise ValueError(f"no feature has {key}")
    present = F.trim(F.col(key).cast("string")) != ""
    once = last_wins(typed.filter(F.coalesce(present, F.lit(False))), [key], [F.col(order)]).drop(order)
    status = F.col("status") if "status" in once.columns else F.lit(None).cast("string")
    tagged = merge.delete_where(once, purge.status_expired(status))
    counts = typed.agg(
        F.count_if(F.coalesce(present, F.lit(False))).alias("loaded"),
        F.count_if(~F.coalesce(present, F.lit(False))).alias("skipped_without_key"),
    )
    return {"table": merge.settle(tagged), "counts": counts, "purge_counts": merge.count_actions(tagged)}


def mirror_schema(spark: SparkSession, source: str, names: list[str], folder: str, reports: str, items: DataFrame,
                  item_type: str, as_of: Column, areas: DataFrame | None = None) -> dict[str, DataFrame]:
    """Copies every table, gives the reports a point, purges the old ones, makes items of the rest."""
    copied = sync_schema(spark, source, names, folder)
    table = spark.read.parquet(f"{folder}/{reports}.parquet")
    placed = table.withColumn("geom", g.lonlat_point(F.col("latitude"), F.col("longitude")))
    rules = purge.report_rules(F.col("received_at"), F.col("processing_status"), as_of.cast("timestamp"))
    tagged = cut_lineage(purge.purge_any(placed, rules))
    kept = merge.settle(tagged)
    synced = sync_photo_items(
        kept.withColumn("uuid", F.col("external_report_id")), items, item_type, reports, as_of,
        id_column="report_id", per_camera=False, areas=areas,
    )
    return {
        "copied": copied, "reports": kept, "purge_counts": merge.count_actions(tagged),
        "items": synced["items"], "sync_counts": synced["counts"],
    }
