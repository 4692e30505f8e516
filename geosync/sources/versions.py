"""Tables as version folders, so that a job may read a table and replace it in one go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def current_version(spark: SparkSession, root: str) -> int:
    """Highest version whose write was committed, 0 when there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/v*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return max((int(f.getPath().getParent().getName()[1:]) for f in found or []), default=0)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/v{current_version(spark, root)}")


def write_version(df: DataFrame, root: str, partition_by: list[str] | None = None) -> int:
    """Writes the next version; readers see the old one until Spark has committed the new one."""
    version = current_version(df.sparkSession, root) + 1
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/v{version}")
    return version
