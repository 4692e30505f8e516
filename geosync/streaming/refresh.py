"""Recomputation of touched items only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geosync.operators.spatial import area_keys
from geosync.sources import buckets


def refresh_changed(changes: DataFrame, geometries: DataFrame, areas: DataFrame, cell: float = 0.05) -> DataFrame:
    """Area keys of the items named in ``changes`` (``task_key``), however often each is named.

    Both the old and the new key of a moved link belong in ``changes``.
    """
    touched = changes.filter(F.col("task_key").isNotNull()).select("task_key").distinct()
    return area_keys(geometries.join(touched, "task_key", "left_semi"), areas, cell=cell)


def refresh_stream(changes: DataFrame, geometries: str, areas: DataFrame, path: str, checkpoint: str,
                   cell: float = 0.05) -> StreamingQuery:
    """Writes the fresh keys of every batch of changes below ``path``, one folder per batch.

    ``geometries`` is the root of a table (``task_key``, ``geom``) in buckets of ``task_key``; a batch opens only the
    buckets its keys lie in.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # A repeated batch overwrites its own folder.
        touched = buckets.touched_by(batch.select("task_key").filter("task_key IS NOT NULL"), geometries)
        held = buckets.read(batch.sparkSession, geometries, touched)
        refresh_changed(batch, held, areas, cell).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
