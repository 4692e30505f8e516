"""File inbox and paged features as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geosync.functions.dates import multi_format_date
from geosync.functions.jsonx import flatten_properties
from geosync.functions.text import strip_to_null
from geosync.operators import links
from geosync.operators.keep import last_wins
from geosync.operators.schema import infer_types, to_columns, type_list
from geosync.session import cut_lineage
from geosync.sources import buckets
from geosync.sources.paged import PAGE_SIZE, paged_feature_stream
from geosync.sources.versions import current_version, read_current, write_version

POLL = "15 seconds"
ASSIGNMENT = "order_no string, date string, executor string"


def parse_assignments(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Assignments per file, the last row of an order winning, and the rows skipped.

    ``rows`` has ``order_no``, ``date``, ``executor``, ``file_name`` and ``ord``.
    """
    read = rows.select(
        "file_name", "ord", strip_to_null(F.col("order_no")).alias("order_no"),
        multi_format_date(F.col("date")).alias("assigned_on"), strip_to_null(F.col("executor")).alias("executor"),
    )
    whole = F.col("order_no").isNotNull() & F.col("assigned_on").isNotNull() & F.col("executor").isNotNull()
    kept = last_wins(read.filter(whole), ["file_name", "order_no"], [F.col("ord")])
    return kept, read.filter(~whole)


def _counted(kept: DataFrame, skipped: DataFrame, target: DataFrame) -> DataFrame:
    """One log row per file: how its rows were matched, and how many were skipped."""
    per_row = links.fallback_match(kept, target, "order_no", "order_name", "order")
    counted = per_row.groupBy("file_name").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("match") == "first").alias("filled_first"),
        F.count_if(F.col("match") == "second").alias("filled_second"),
        F.count_if(F.col("match") == "missing").alias("missing"),
    )
    dropped = skipped.groupBy("file_name").agg(F.count("*").alias("skipped_rows"))
    return counted.join(dropped, "file_name", "full_outer").fillna(0)


def apply_assignments(rows: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Target with dates and executors filled in, and one log row per file."""
    kept, skipped = parse_assignments(rows)
    # Files are taken in name order: of two files naming an order the later one holds.
    final = last_wins(kept, ["order_no"], [F.col("file_name"), F.col("ord")])
    matched = links.fallback_match(final, target, "order_no", "order_name", "order")
    updated = links.apply_fallback(target, matched, "order_no", "order_name", "order", ["assigned_on", "executor"])
    return updated.drop("action"), _counted(kept, skipped, target)


def apply_to_buckets(rows: DataFrame, root: str) -> tuple[DataFrame, list[int]]:
    """Applies assignments to the bucketed table at ``root``: one log row per file, and the buckets rewritten.

    Of the whole table only the two columns that orders are found by are read; rows are read and written in the buckets
    that hold a match. Applied again, the same rows give the same table.
    """
    spark = rows.sparkSession
    kept, skipped = parse_assignments(rows)
    final = last_wins(kept, ["order_no"], [F.col("file_name"), F.col("ord")])
    whole = buckets.read(spark, root)
    matched = cut_lineage(links.fallback_match(final, whole, "order_no", "order_name", "order"))
    numbers = whole.select("order_name", "order", buckets.bucket_of(spark, root).alias("b"))
    found = [
        numbers.join(matched.filter(F.col("match") == how).select(F.col("order_no").alias(column)), column, "left_semi").select("b")
        for how, column in (("first", "order_name"), ("second", "order"))
    ]
    touched = sorted(r["b"] for r in found[0].unionAll(found[1]).distinct().collect())
    log = cut_lineage(_counted(kept, skipped, whole))
    updated = links.apply_fallback(buckets.read(spark, root, touched), matched, "order_no", "order_name", "order", ["assigned_on", "executor"])
    buckets.replace(updated.drop("action"), root, touched)
    return log, touched


def inbox_stream(spark: SparkSession, inbox: str, target_root: str, log_path: str, checkpoint: str,
                 once: bool = False) -> StreamingQuery:
    """Polls a folder of CSV files and applies each batch to the bucketed target table.

    Files being written are told by name and left for a later poll; a file is read once. Only buckets with a matched
    row are written anew.
    """
    files = (
        spark.readStream.schema(ASSIGNMENT)
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", "[!~.]*.csv")
        .csv(inbox)
        .withColumn("file_name", F.col("_metadata.file_name"))
        .withColumn("block", F.col("_metadata.file_block_start"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        # A batch that is run again overwrites its own log and changes nothing twice: the update is by key.
        ordered = batch.withColumn("ord", F.struct("block", F.monotonically_increasing_id().alias("row"))).drop("block")
        log, _ = apply_to_buckets(ordered, target_root)
        log.write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")

    writer = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=POLL)).start()


def paged_stream(spark: SparkSession, pages: str, target: str, types_root: str, checkpoint: str,
                 once: bool = False, page_size: int = PAGE_SIZE) -> StreamingQuery:
    """Appends features as pages arrive, of a service or of stored pages; the first type seen for a column holds for all.

    How far the pages were read is kept in the checkpoint, so a stream that is started again goes on from there.
    """
    stream = paged_feature_stream(spark, pages, page_size=page_size).withColumnRenamed("idx", "ord")

    def write(batch: DataFrame, batch_id: int) -> None:
        known = (
            [(r["name"], r["type"]) for r in read_current(spark, types_root).collect()]
            if current_version(spark, types_root)
            else []
        )
        members = batch.withColumn("members", flatten_properties(F.get_json_object("feature", "$.properties")))
        types = dict(type_list(infer_types(members)))
        types.update(dict(known))
        if set(types) - set(dict(known)):
            write_version(spark.createDataFrame(sorted(types.items()), "name string, type string"), types_root)
        # One folder per batch: a batch that is run again replaces its own rows.
        to_columns(members, sorted(types.items())).withColumn(
            "geometry", F.get_json_object("feature", "$.geometry")
        ).drop("feature").write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=POLL)).start()
