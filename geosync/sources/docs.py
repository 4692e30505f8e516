"""JSON documents by kind, result arrays, pushed payloads, station layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geosync.functions import geom as g
from geosync.functions.jsonx import classify_document, maybe_dict, parse_coords
from geosync.functions.reproject import LOCAL_SRID, reproject
from geosync.functions.text import blank_to_null, strip_to_null

# Members of a permit record, their columns, and those kept as JSON.
PERMIT_ROOT = {
    "dataset_id": "datasetId", "row_id": "rowId", "version_number": "versionNumber",
    "release_number": "releaseNumber",
}
PERMIT_ATTRIBUTES = {
    "order_number": "OrderNumber", "order_date": "OrderDate",
    "customer_construction": "CustomerConstruction", "customer_construction_inn": "CustomerConstructionINN",
    "general_contractor": "GeneralContractor", "general_contractor_inn": "GeneralContractorINN",
    "work_type": "WorkType", "order_work": "OrderWork", "earthwork_objectives": "EarthworkObjectives",
    "objectives_temp_fences": "ObjectivesOfTheInstallationOfTemporaryFences",
    "objectives_temp_objects": "ObjectivesOfThePlacementOfTemporaryObjects",
    "address_nearby_building": "AddressOfNearbyBuilding", "adm_area": "AdmArea", "district": "District",
    "work_place_description": "WorkPlaceDescription", "work_start_date": "WorkStartDate",
    "work_end_date": "WorkEndDate", "global_id": "global_id",
}
PERMIT_JSON = (
    "work_type", "order_work", "earthwork_objectives", "objectives_temp_fences", "objectives_temp_objects",
)

RESULT = (
    "struct<id:string,origin_screenshot_id:string,device:string,camera:string,create_timestamp:bigint,"
    "image:string,image_type:int,issues:string,latitude:double,longitude:double,angle:int,speed:double,"
    "valid:boolean,height:double,ptz_position:string>"
)


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    """``file_name``, ``doc`` and ``kind`` for every JSON file; ``kind`` is NULL when no rule takes it."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json").select(
        F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("doc")
    )
    return route_docs(files)


def route_docs(docs: DataFrame) -> DataFrame:
    return docs.withColumn("kind", classify_document(F.col("doc")))


def explode_ids(docs: DataFrame) -> DataFrame:
    """One row per element of ``uuids``, with the document it came from."""
    ids = F.from_json("doc", "uuids array<string>")["uuids"]
    return docs.select("*", F.explode(ids).alias("uuid"))


def with_coords(docs: DataFrame) -> DataFrame:
    """Adds ``lat``, ``lng`` as parsed, and the point."""
    at = docs.withColumn("_c", parse_coords(F.col("doc")))
    return at.select(
        *docs.columns,
        F.col("_c.lat").alias("lat"),
        F.col("_c.lng").alias("lng"),
        g.point(F.col("_c.lng"), F.col("_c.lat")).alias("geom"),
    )


def flatten_permit(df: DataFrame, doc: str = "doc") -> DataFrame:
    """The fixed columns of a permit record; lists and objects stay JSON where a column keeps them."""
    attributes = maybe_dict(F.get_json_object(doc, "$.attributes"))
    step = df.withColumn("_a", attributes)
    root = [blank_to_null(F.get_json_object(doc, f"$.{m}")).alias(c) for c, m in PERMIT_ROOT.items()]
    root[0] = F.get_json_object(doc, "$.datasetId").try_cast("int").alias("dataset_id")
    members = []
    for column, member in PERMIT_ATTRIBUTES.items():
        value = F.get_json_object("_a", f"$.{member}")
        if column in PERMIT_JSON:
            value = F.when(value.rlike(r"^[\[{]"), value)
        if column == "global_id":
            value = value.try_cast("bigint")
        members.append(value.alias(column))
    return step.select(*df.columns, *root, *members)


def flatten_response(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Columns of a photo answer; the photo point only when both coordinates are there."""
    get = lambda path: F.get_json_object(doc, f"$.{path}")
    date = lambda path: blank_to_null(get(path)).try_cast("date")
    lat, lng = get("photo_coordinate.lat").try_cast("double"), get("photo_coordinate.lng").try_cast("double")
    return df.select(
        *df.columns,
        get("opening").try_cast("boolean").alias("opening"),
        get("legal").try_cast("boolean").alias("legal"),
        get("description").alias("description"),
        get("image").alias("image"),
        lat.alias("photo_lat"),
        lng.alias("photo_lng"),
        get("photo_coordinate.azimuth_deg").try_cast("int").alias("photo_azimuth_deg"),
        get("order.source").alias("order_source"),
        get("order.doc_num").alias("order_doc_num"),
        get("order.work_types").alias("order_work_types"),
        date("order.date_start").alias("order_date_start"),
        date("order.date_end").alias("order_date_end"),
        get("order.customer").alias("order_customer"),
        get("order.status").alias("order_status"),
        get("yolo.label").try_cast("int").alias("yolo_label"),
        get("yolo.votes").alias("yolo_votes"),
        g.point(lng, lat).alias("photo_geom"),
    )


def parse_results(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the ``results`` arrays of a frame with ``value`` and ``source_file``; and the files without one."""
    read = files.withColumn("_r", F.from_json("value", f"provider string, results array<{RESULT}>"))
    bad = read.filter(F.col("_r.results").isNull()).select("source_file")
    rows = read.select("source_file", F.col("_r.provider").alias("provider"), F.explode("_r.results").alias("r"))
    return (
        rows.select(
            F.col("r.id").alias("result_id"),
            *[strip_to_null(F.col(f"r.{c}")).alias(c) for c in ("origin_screenshot_id", "device", "camera")],
            F.col("r.create_timestamp").alias("create_timestamp"),
            F.timestamp_seconds("r.create_timestamp").alias("created_at"),
            F.col("r.image").alias("image"),
            F.col("r.image_type").alias("image_type"),
            F.coalesce("r.issues", F.lit("[]")).alias("issues"),
            F.col("r.latitude").alias("latitude"),
            F.col("r.longitude").alias("longitude"),
            g.point(F.col("r.longitude"), F.col("r.latitude")).alias("geom"),
            *[F.col(f"r.{c}").alias(c) for c in ("angle", "speed", "valid", "height", "ptz_position")],
            "source_file",
            "provider",
        ),
        bad,
    )


def read_results(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("source_file"))
    return parse_results(files)


def validate_payloads(df: DataFrame, path_uuid: str = "path_uuid", body: str = "body") -> DataFrame:
    """Adds ``reason``, NULL for an accepted payload: the body must be an object with the uuid of the path."""
    inner = blank_to_null(F.get_json_object(body, "$.uuid"))
    reason = (
        F.when(F.json_object_keys(F.col(body)).isNull(), F.lit("not an object"))
        .when(inner.isNull(), F.lit("uuid is required"))
        .when(inner != F.trim(path_uuid), F.lit("uuid mismatch"))
    )
    return df.withColumn("reason", reason)


def station_import(df: DataFrame, text_columns: list[str], int_columns: list[str], srid: int = LOCAL_SRID) -> DataFrame:
    """Station rows in WGS84 with ``layer`` and a constant flag; rows without geometry have layer ``skipped``.

    Layers other than points and lines get a NULL ``layer``, as neither table takes them.
    """
    moved = df.withColumn("geom", reproject(F.col("geom"), srid))
    layer = F.when(g.is_empty(F.col("geom")), F.lit("skipped")).when(
        g.layer_of(F.col("geom")).isin("points", "lines"), g.layer_of(F.col("geom"))
    )
    return moved.select(
        *[F.col(c).cast("string").alias(c) for c in text_columns],
        *[F.col(c).try_cast("int").alias(c) for c in int_columns],
        F.lit(True).alias("base_poly_usage"),
        "geom",
        layer.alias("layer"),
    )
