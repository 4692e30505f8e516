"""Row numbers within groups of any size, and the free numbers of a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geosync.session import cut_lineage


def number_rows(df: DataFrame, partition: list[str], order: list[Column], out: str) -> DataFrame:
    """Adds ``row_number()`` over ``partition`` in ``order``, as a long.

    ``order`` must be total within a group. The rows are range-sorted over the cluster and numbered by
    position, so no task ever holds a whole group.
    """
    keys = [*[F.col(c).asc() for c in partition], *order]
    # The sorted rows are written once: both passes below must see the same ranges.
    ranged = cut_lineage(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    placed = ranged.withColumn("_nr_pid", F.spark_partition_id()).withColumn(
        "_nr_at", F.monotonically_increasing_id()
    )
    local = Window.partitionBy("_nr_pid", *partition).orderBy("_nr_at")
    numbered = placed.withColumn("_nr_n", F.row_number().over(local).cast("long"))
    # Rows of the same group in earlier ranges. Only the first group of a range can have any, so
    # there are no more such entries than ranges.
    sizes = placed.groupBy("_nr_pid", *partition).agg(F.count("*").alias("_nr_size"))
    before = Window.partitionBy(*partition).orderBy("_nr_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sizes.withColumn("_nr_skip", F.coalesce(F.sum("_nr_size").over(before), F.lit(0)))
        .filter("_nr_skip > 0")
        .drop("_nr_size")
    )
    same = F.col("n._nr_pid") == F.col("o._nr_pid")
    for c in partition:
        same = same & F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
    joined = numbered.alias("n").join(F.broadcast(offsets).alias("o"), same, "left")
    return joined.select(
        *[F.col(f"n.`{c}`") for c in df.columns],
        (F.col("n._nr_n") + F.coalesce(F.col("o._nr_skip"), F.lit(0))).alias(out),
    )


# Width of the number ranges that one task walks through when free numbers are looked up.
FREE_CHUNK = 100_000


def allocate_free(losers: DataFrame, used: DataFrame, prefix: str = "prefix", seq: str = "seq",
                  n: str = "n", chunk: int = FREE_CHUNK) -> DataFrame:
    """Adds ``new_n``: the ``seq``-th number from 1 up that ``used`` leaves free for the prefix.

    ``seq`` counts the losers of a prefix from 1. With the i-th used number u there are u - i free
    ones up to u, so the answer is seq plus the count of used numbers with fewer than seq free ones
    up to them. That count is a running maximum, taken chunk by chunk; no series is written out.
    """
    taken = used.select(prefix, F.col(n).cast("long").alias("_n")).filter("_n >= 1").distinct()
    ranked = number_rows(taken, [prefix], [F.col("_n").asc()], "_i")
    steps = (
        ranked.select(prefix, (F.col("_n") - F.col("_i")).alias("_free"), "_i")
        .groupBy(prefix, "_free")
        .agg(F.max("_i").alias("_i"))
        .withColumn("_ask", F.lit(False))
    )
    asks = losers.select(
        prefix,
        F.col(seq).cast("long").alias("_free"),
        F.lit(None).cast("long").alias("_i"),
        F.lit(True).alias("_ask"),
    )
    # An ask sees strictly smaller steps only, so it sorts before an equal one.
    marks = asks.unionByName(steps).withColumn("_chunk", F.floor(F.col("_free") / chunk))
    near = (
        Window.partitionBy(prefix, "_chunk")
        .orderBy("_free", F.col("_ask").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = marks.withColumn("_near", F.max("_i").over(near)).filter("_ask")
    earlier = Window.partitionBy(prefix).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        marks.groupBy(prefix, "_chunk")
        .agg(F.max("_i").alias("_top"))
        .withColumn("_far", F.max("_top").over(earlier))
        .select(prefix, "_chunk", "_far")
    )
    answers = local.join(carried, [prefix, "_chunk"]).select(
        prefix,
        F.col("_free").alias("_seq"),
        (F.col("_free") + F.coalesce(F.col("_near"), F.col("_far"), F.lit(0))).alias("new_n"),
    )
    return losers.withColumn("_seq", F.col(seq).cast("long")).join(answers, [prefix, "_seq"]).drop("_seq")
