"""Connected components of a graph given as links, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosync.llm.staging import discard, stage


def _least(pairs: DataFrame) -> DataFrame:
    """Per ``u`` its smallest neighbour or itself; hot nodes are reduced before the shuffle."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are hung on its smallest one."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node, are hung on the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    hung = down.join(_least(down), "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(hung.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``label``, the smallest id reachable, of every id in ``links`` (two columns of ids).

    Large and small stars by turns until nothing moves; the rounds grow with the logarithm of the longest path, no group
    is collected, and each round is written so that a lost executor costs one round at most. Links to oneself and with
    a null end are left out.
    """
    a, b = links.columns
    now = stage(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        after = stage(_small_star(_large_star(now)).where("u <> v").distinct(), "links")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        discard(now)
        now = after
        if mark == before:
            return now.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("label")).unionAll(
                now.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
            )
        before = mark
