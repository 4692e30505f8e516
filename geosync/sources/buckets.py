"""Keyed tables in buckets, of which a change rewrites only those it touches.

Rows lie in a bucket by the hash of their key. A write puts the new rows of some buckets below ``data/v=<n>`` and then a
list of which version holds which bucket, as the next version of a small table. Readers follow the newest whole list, so
a write that fails, or runs again, changes nothing they see.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from geosync.sources.versions import current_version, read_current, write_version

BUCKETS = 64
_LISTED = "bucket int, version int, info string"
# The list's row that describes the table.
_ABOUT = -1


def _listed(spark: SparkSession, root: str) -> tuple[dict[int, int], dict]:
    """Version of each bucket that has rows, and the table's keys, schema and number of buckets."""
    rows = read_current(spark, f"{root}/list").collect()
    about = next(json.loads(r["info"]) for r in rows if r["bucket"] == _ABOUT)
    return {r["bucket"]: r["version"] for r in rows if r["bucket"] != _ABOUT}, about


def _bucket(about: dict) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in about["keys"]]), F.lit(about["buckets"])).cast("int")


def bucket_of(spark: SparkSession, root: str) -> Column:
    """The bucket of a row that has the table's key columns."""
    return _bucket(_listed(spark, root)[1])


def _write(df: DataFrame, root: str, version: int, about: dict) -> set[int]:
    """Buckets that got rows in this version."""
    path = f"{root}/data/v={version}"
    # each bucket is one task's work, and a bucket is bounded by their number
    placed = df.withColumn("_bucket", _bucket(about)).repartition(about["buckets"], "_bucket")
    placed.write.mode("overwrite").partitionBy("_bucket").parquet(path)
    written = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_bucket=*")
    found = written.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).globStatus(written)
    return {int(f.getPath().getName().partition("=")[2]) for f in found or []}


def _commit(spark: SparkSession, root: str, held: dict[int, int], about: dict) -> None:
    rows = [(_ABOUT, 0, json.dumps(about)), *((b, v, None) for b, v in sorted(held.items()))]
    write_version(spark.createDataFrame(rows, _LISTED).coalesce(1), f"{root}/list")


def create(df: DataFrame, root: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Writes the whole table; one that is there already gets a new list."""
    about = {"keys": keys, "buckets": buckets, "schema": df.schema.json()}
    version = current_version(df.sparkSession, f"{root}/list") + 1
    _commit(df.sparkSession, root, {b: version for b in _write(df, root, version, about)}, about)


def read(spark: SparkSession, root: str, touched: list[int] | None = None) -> DataFrame:
    """The table, or only its rows in some buckets, of which other files are not opened."""
    held, about = _listed(spark, root)
    schema = StructType.fromJson(json.loads(about["schema"]))
    paths = [f"{root}/data/v={v}/_bucket={b}" for b, v in sorted(held.items()) if touched is None or b in set(touched)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def touched_by(rows: DataFrame, root: str) -> list[int]:
    """Buckets of the keys in ``rows``, at most as many as the table has."""
    return sorted(r[0] for r in rows.select(bucket_of(rows.sparkSession, root).alias("b")).distinct().collect())


def replace(df: DataFrame, root: str, touched: list[int]) -> int:
    """Puts ``df`` in place of the rows of the buckets named; it must hold no others. Returns the buckets rewritten."""
    spark = df.sparkSession
    if not touched:
        return 0
    held, about = _listed(spark, root)
    version = current_version(spark, f"{root}/list") + 1
    schema = StructType.fromJson(json.loads(about["schema"]))
    found = _write(df.select(*schema.fieldNames()), root, version, about)
    if not found <= set(touched):
        raise ValueError("rows of other buckets than those to replace")
    kept = {b: v for b, v in held.items() if b not in set(touched)}
    _commit(spark, root, kept | {b: version for b in found}, about)
    return len(set(touched))
