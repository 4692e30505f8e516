"""GeoJSON in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geosync.functions import geom as g
from geosync.functions.crs import WGS84, code_of, to_wgs84
from geosync.functions.jsonx import flatten_properties, unwrap_envelope
from geosync.operators.schema import infer_types, to_columns, type_list
from geosync.session import cut_lineage
from geosync.sources.ranges import RANGE, split_features

def features_of(collection: Column) -> Column:
    """Feature texts of a collection."""
    return unwrap_envelope(collection)


def read_geojson(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """``file_name``, ``ord``, ``properties`` and ``geom`` in WGS84 for every feature of the collections at ``path``.

    A file is read in ranges of bytes, by as many tasks.
    """
    listed = split_features(spark, path, range_bytes)
    return _parse(listed.select("file_name", F.get_json_object("crs", "$.properties.name").alias("_crs"), "ord", F.col("feature").alias("_f")))


def parse_collections(files: DataFrame) -> DataFrame:
    """Same for a frame with ``value`` and ``file_name``."""
    crs = F.get_json_object("value", "$.crs.properties.name")
    listed = files.select("file_name", crs.alias("_crs"), F.posexplode(features_of(F.col("value"))).alias("ord", "_f"))
    return _parse(listed)


def read_geojson_lines(spark: SparkSession, path: str) -> DataFrame:
    """Same for newline-delimited features, which split over tasks."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file_name"), F.lit(None).cast("string").alias("_crs"),
        F.monotonically_increasing_id().alias("ord"), F.col("value").alias("_f"),
    )
    return _parse(lines)


def _parse(listed: DataFrame) -> DataFrame:
    parsed = listed.select(
        "file_name",
        "ord",
        "_crs",
        F.get_json_object("_f", "$.properties").alias("properties"),
        g.from_geojson(F.get_json_object("_f", "$.geometry")).alias("_g"),
    )
    # Degrees pass by the projection as NULL.
    placed = parsed.withColumn("_code", code_of(F.col("_crs")))
    foreign = placed.withColumn("_away", F.when(F.col("_code") != WGS84, F.col("_g")).cast(g.GEOMETRY))
    moved = to_wgs84(F.col("_away"), F.col("_code"))
    geom = F.when(F.col("_code") == WGS84, F.col("_g")).otherwise(F.col("_moved"))
    return foreign.withColumn("_moved", moved).select("file_name", "ord", "properties", geom.alias("geom"))


def typed_features(features: DataFrame, known: list[tuple[str, str]] | None = None) -> tuple[DataFrame, list]:
    """Properties as typed columns beside the other columns, and the types.

    Types already known stay; names seen first here are added. The features are parsed once and
    written; the types and the columns are then read from there.
    """
    members = cut_lineage(features.withColumn("members", flatten_properties(F.col("properties"))).drop("properties"))
    types = dict(type_list(infer_types(members)))
    types.update(dict(known or []))
    ordered = sorted(types.items())
    return to_columns(members, ordered), ordered


def to_feature_lines(df: DataFrame, properties: list[str]) -> DataFrame:
    """One GeoJSON feature text per row, as ``value``."""
    body = F.to_json(F.struct(*[F.col(p) for p in properties]), {"ignoreNullFields": "false"})
    geometry = F.coalesce(g.to_geojson(F.col("geom")), F.lit("null"))
    return df.select(
        F.concat(
            F.lit('{"type":"Feature","geometry":'), geometry, F.lit(',"properties":'), body, F.lit("}")
        ).alias("value")
    )


def write_geojson(df: DataFrame, path: str, properties: list[str]) -> None:
    """Newline-delimited GeoJSON, one file per task."""
    to_feature_lines(df, properties).write.mode("overwrite").text(path)


def kind_stats(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("geom.kind").alias("kind")).agg(F.count("*").alias("n"))
