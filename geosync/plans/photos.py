"""Photo worklists: what is still to fetch, upload or download, and the outcome log."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosync.functions.text import effective_id, is_photo, legacy_name, normalize_path, not_prefix_or_null, path_after_marker
from geosync.operators import links, merge


def found_worklist(found: DataFrame, areas: DataFrame, meta: DataFrame, uploaded: DataFrame) -> DataFrame:
    """Found ids that no table knows and no area search recorded."""
    return links.new_ids(found, areas, meta.select("uuid"), uploaded.select("uuid"))


def meta_worklist(uploaded: DataFrame, meta: DataFrame | None, order: str = "loaded_at") -> DataFrame:
    """Uploaded photos whose metadata is missing or unfinished, oldest first."""
    columns = [F.col(c) for c in ("uuid", "photo_uuid") if c in uploaded.columns]
    ids = uploaded.withColumn("uuid", effective_id(*columns)).filter("uuid IS NOT NULL")
    return links.pending(ids, meta).orderBy(order, "uuid")


def order_worklist(orders: DataFrame, prefix: str, operation: str, since: date) -> DataFrame:
    """Checked orders under a number prefix after a day, in order of day and id."""
    chosen = orders.filter(
        F.col("ogno").startswith(prefix) & (F.col("opernm") == operation) & (F.col("edf") > F.lit(since))
    )
    return chosen.orderBy("edf", "oid")


def file_worklist(orders: DataFrame, files: DataFrame, prefix: str, operation: str, since: date) -> DataFrame:
    """Files of the orders outside a number prefix, with their normalized path or the reason against it."""
    chosen = orders.filter(
        not_prefix_or_null(F.col("ono"), prefix) & (F.col("opernm") == operation) & (F.col("edf") > F.lit(since))
    )
    joined = chosen.join(files, "oid").withColumn("_p", normalize_path(F.col("fnm")))
    return joined.select(
        "oid", "ono", "ogno", "edf", "fnm", F.col("_p.relpath").alias("relpath"), F.col("_p.error").alias("error")
    ).orderBy("edf", "oid", "fnm")


def match_files(worklist: DataFrame, listing: DataFrame) -> DataFrame:
    """Outcome per wanted path: ``bad_path``, ``missing``, or one ``photo`` row per picture found.

    A path names a picture or a folder of pictures; the listing has ``relpath``.
    """
    pictures = listing.filter(is_photo(F.col("relpath"))).select(
        F.col("relpath").alias("photo"), F.regexp_replace("relpath", "/?[^/]*$", "").alias("_folder")
    )
    # One equi join: each picture under its own path and under its folder.
    places = pictures.select("photo", F.explode(F.array("photo", "_folder")).alias("relpath"))
    joined = worklist.join(places, "relpath", "left")
    outcome = (
        F.when(F.col("error").isNotNull(), F.lit("bad_path"))
        .when(F.col("photo").isNull(), F.lit("missing"))
        .otherwise(F.lit("photo"))
    )
    return joined.withColumn("outcome", outcome)


def order_folders(worklist: DataFrame, marker: str, subfolder: str) -> DataFrame:
    """Photo folder of each order below the marker folder of its address, or the reason there is none."""
    made = worklist.withColumn("_p", path_after_marker(F.col("url"), marker))
    return made.select(
        *worklist.columns,
        F.concat_ws("/", F.col("_p.relpath"), F.when(F.col("_p.relpath").isNotNull(), F.lit(subfolder))).alias("relpath"),
        F.col("_p.error").alias("error"),
    )


def record_outcomes(log: DataFrame, outcomes: DataFrame, order: list[Column]) -> DataFrame:
    """Log with the outcomes written by path; an uploaded row stands, an id once known stays."""
    still_open = ~F.col("t.status").eqNullSafe(F.lit("uploaded"))
    return merge.upsert(log, outcomes, ["source_relpath"], order, when=still_open, keep_non_null=["photo_uuid"])


def download_worklist(meta: DataFrame, stored: DataFrame) -> DataFrame:
    """Per photo ``stored``, ``reuse`` (a unique old name is on disk) or ``fetch``.

    ``stored`` has ``name``: file names already in the download folder.
    """
    named = links.unique_names(meta.withColumn("legacy", legacy_name(F.col("image_name"))), "legacy")
    stems = stored.select(F.regexp_replace("name", r"\.[^.]*$", "").alias("uuid")).distinct().withColumn("_have", F.lit(True))
    names = stored.select(F.col("name").alias("legacy")).distinct().withColumn("_old", F.lit(True))
    joined = named.join(stems, "uuid", "left").join(names, "legacy", "left")
    action = (
        F.when(F.col("_have").isNotNull(), F.lit("stored"))
        .when(F.col("name_unique") & F.col("_old").isNotNull(), F.lit("reuse"))
        .otherwise(F.lit("fetch"))
    )
    return joined.select(*meta.columns, "legacy", action.alias("action"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """The dry-run report: rows per outcome, nothing written."""
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n"))
