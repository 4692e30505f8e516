"""Run log: one appended row when a job starts and one when it ends."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geosync.operators.keep import latest_per

SCHEMA = "run_id string, job_name string, status string, message string, rows_affected bigint, logged_at double"


def log_run(spark: SparkSession, path: str, job: str, status: str, message: str, rows: int | None = None,
            run_id: str | None = None) -> str:
    """Appends one row and returns the run id to finish the run with."""
    run_id = run_id or uuid.uuid4().hex
    row = (run_id, job, status, message, rows, time.time())
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return run_id


def runs(log: DataFrame) -> DataFrame:
    """One row per run in its latest state, with start and end."""
    ended = F.when(F.col("status") != "running", F.col("logged_at"))
    times = log.groupBy("run_id").agg(F.min("logged_at").alias("started_at"), F.max(ended).alias("finished_at"))
    return latest_per(log, [F.col("run_id")], [F.col("logged_at"), F.col("status")]).drop("logged_at").join(times, "run_id")
