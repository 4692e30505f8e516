"""Tables of a remote database or of Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FETCH_ROWS = "250"


def read_table(spark: SparkSession, source: str, table: str, columns: list[str] | None = None,
               partition: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """Snapshot of a table: a JDBC address, split by a numeric column, or a Parquet folder."""
    if source.startswith("jdbc:"):
        reader = spark.read.format("jdbc").options(url=source, dbtable=table, fetchsize=FETCH_ROWS, **options)
        if partition:
            column, low, high, parts = partition
            reader = reader.options(
                partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts
            )
        df = reader.load()
    else:
        df = spark.read.parquet(f"{source}/{table}.parquet")
    return df.select(*columns) if columns else df


def read_incremental(df: DataFrame, key: str, last: int, bootstrap: int = 50) -> DataFrame:
    """Rows above the high-water mark; without a mark, the ``bootstrap`` newest rows."""
    if last <= 0:
        return df.orderBy(F.col(key).desc()).limit(bootstrap)
    return df.filter(F.col(key) > last)


def read_by_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is listed; adaptive execution broadcasts a list of few bytes."""
    wanted = keys.select(F.col(keys.columns[0]).alias("_key")).distinct()
    return df.join(wanted, F.col(key) == F.col("_key"), "left_semi")


def missing_keys(keys: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Listed keys that the table lacks."""
    wanted = keys.select(F.col(keys.columns[0]).alias(key)).distinct()
    return wanted.join(df.select(key), key, "left_anti")


def sync_schema(spark: SparkSession, source: str, tables: list[str], target: str) -> DataFrame:
    """Copies every table to the target folder and returns ``table_name`` and ``n``, counted from the copies."""
    counts = None
    for table in tables:
        read_table(spark, source, table).write.mode("overwrite").parquet(f"{target}/{table}.parquet")
        n = spark.read.parquet(f"{target}/{table}.parquet").agg(F.count("*").alias("n"))
        row = n.select(F.lit(table).alias("table_name"), "n")
        counts = row if counts is None else counts.unionByName(row)
    return counts
