"""File lists as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geosync.functions.text import PHOTO_SUFFIXES

# Marks of files still being written, and the least age of a finished one.
TEMP_PREFIXES = ("~$",)
TEMP_SUFFIXES = (".tmp", ".part", ".crdownload")
MIN_AGE_SECONDS = 2


def list_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = PHOTO_SUFFIXES) -> DataFrame:
    """``path``, ``relpath``, ``length``, ``modified`` of the files below ``root``; contents are not read."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
    base = root.rstrip("/").split(":")[-1]
    rel = F.regexp_replace(F.split_part("path", F.lit(base), F.lit(2)), "^/+", "")
    return listed.withColumn("relpath", rel).filter(
        F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).isin(*suffixes)
    )


def is_ready(name: Column, modified: Column, now: Column, suffixes: tuple[str, ...]) -> Column:
    """Right suffix, no mark of a file being written, and old enough."""
    lowered = F.lower(name)
    temp = F.lit(False)
    for prefix in TEMP_PREFIXES:
        temp = temp | name.startswith(prefix)
    for suffix in TEMP_SUFFIXES:
        temp = temp | lowered.endswith(suffix)
    age = now.cast("double") - modified.cast("double")
    return F.regexp_extract(lowered, r"(\.[^.]*)$", 1).isin(*suffixes) & ~temp & (age >= MIN_AGE_SECONDS)
