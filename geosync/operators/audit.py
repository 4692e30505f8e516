"""Counts that tell whether layers, parents and work items agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosync.functions.text import is_true


def filtered_counts(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    return df.agg(F.count("*").alias("total"), *[F.count_if(t).alias(n) for n, t in tests.items()])


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Non-null keys that occur more than once, with their count ``n``."""
    present = df
    for key in keys:
        present = present.filter(F.col(key).isNotNull())
    return present.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_geometries(df: DataFrame, key: str, limit: int = 5) -> DataFrame:
    """Largest groups sharing a business id and a geometry hash: the rows a restore may confuse."""
    groups = duplicates(df, [key, "geom_hash"])
    return groups.orderBy(F.col("n").desc(), F.col(key), F.col("geom_hash")).limit(limit)


def link_audit(layers: DataFrame, items: DataFrame) -> DataFrame:
    """Per service and layer: rows, geometries, links, gaps, matches, missing items, percent linked.

    ``layers`` has ``service``, ``layer``, ``business_id``, ``has_geom`` and ``task_key``; ``items`` has
    ``service`` and ``business_id``. One pass over the tagged union.
    """
    known = items.select("service", "business_id").distinct().withColumn("_known", F.lit(True))
    joined = layers.join(known, ["service", "business_id"], "left")
    gap = F.col("has_geom") & F.col("task_key").isNull()
    counts = joined.groupBy("service", "layer").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("has_geom")).alias("with_geom"),
        F.count("task_key").alias("linked"),
        F.count_if(gap).alias("gap"),
        (F.count("task_key") + F.count_if(gap & F.col("_known").isNotNull())).alias("item_match"),
        F.count_if(gap & F.col("_known").isNull()).alias("would_insert"),
    )
    percent = F.round(F.try_divide(F.col("linked") * 100.0, F.col("with_geom")), 1)
    return counts.withColumn("linked_pct", F.coalesce(percent, F.lit(0.0)))


def false_flags(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Per service, flagged parents without a linked child. Both frames have ``service``."""
    linked = children.filter(F.col("task_key").isNotNull()).select("service", F.col("source_id").alias("id"))
    wrong = parents.filter(is_true(F.col("tasked"))).join(linked, ["service", "id"], "left_anti")
    counts = wrong.groupBy("service").agg(F.count("*").alias("n"))
    services = parents.select("service").distinct()
    return services.join(counts, "service", "left").select("service", F.coalesce("n", F.lit(0)).alias("n"))


def scoped_counts(items: DataFrame, id_columns: list[str]) -> DataFrame:
    """Per id column, items scoped to points, lines and polygons."""
    pairs = F.array(*[F.struct(F.lit(c).alias("id_column"), F.col(c).alias("id")) for c in id_columns])
    long = items.select(F.explode(pairs).alias("p")).select("p.*")
    starts = lambda kind: F.count_if(F.col("id").startswith(f"{kind}:"))
    return long.groupBy("id_column").agg(
        starts("point").alias("point"),
        starts("line").alias("line"),
        starts("polygon").alias("polygon"),
        F.count_if(F.col("id").rlike("^(point|line|polygon):")).alias("total"),
    )


def _side_by_side(*rows: DataFrame) -> DataFrame:
    """One row from several one-row frames with different columns."""
    stacked = rows[0]
    for row in rows[1:]:
        stacked = stacked.unionByName(row, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def summary(links: DataFrame, flags: DataFrame, scoped: DataFrame, duplicate_keys: DataFrame,
            expected: list[str]) -> DataFrame:
    """One alert row: ``alert`` and ``message``, with the sums behind them."""
    totals = links.agg(F.sum("with_geom").alias("with_geom"), F.sum("gap").alias("gap"))
    wrong = flags.agg(F.sum("n").alias("false_flags"))
    empty = scoped.filter(F.col("id_column").isin(*expected) & (F.col("total") == 0)).agg(
        F.array_join(F.array_sort(F.collect_list("id_column")), ",").alias("zero_scoped")
    )
    twice = duplicate_keys.agg(F.count("*").alias("duplicate_keys"))
    row = _side_by_side(totals, wrong, empty, twice)
    parts = F.concat_ws(
        "; ",
        F.when(F.col("gap") > 0, F.concat(F.lit("gap="), F.col("gap").cast("string"))),
        F.when(F.col("zero_scoped") != "", F.concat(F.lit("zero_scoped="), F.col("zero_scoped"))),
        F.when(F.col("false_flags") > 0, F.concat(F.lit("false_tasked="), F.col("false_flags").cast("string"))),
        F.when(F.col("duplicate_keys") > 0, F.concat(F.lit("duplicate_task_key="), F.col("duplicate_keys").cast("string"))),
    )
    return row.withColumn("alert", parts != "").withColumn(
        "message", F.when(parts == "", F.lit("OK")).otherwise(parts)
    )


def bucket_counts(df: DataFrame, at: str, unit: str, zone: str, tests: dict[str, Column]) -> DataFrame:
    """Counts per time bucket on the clock of ``zone``."""
    bucket = F.date_trunc(unit, F.from_utc_timestamp(F.col(at), zone))
    return df.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("n"), *[F.count_if(t).alias(n) for n, t in tests.items()]
    )


def _digest_sum(text: Column) -> Column:
    """Order-free sum of the first 32 bits of the MD5."""
    word = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("decimal(20,0)")
    return F.sum(word).cast("decimal(38,0)")


def fingerprint(df: DataFrame, key: Column, row: Column) -> DataFrame:
    """Row count and order-free digests of keys and rows, for comparing two copies of a table."""
    return df.agg(
        F.count("*").alias("n"),
        _digest_sum(key).cast("string").alias("keys_digest"),
        _digest_sum(row).cast("string").alias("rows_digest"),
    )


def check_links(before: DataFrame, after: DataFrame, link: str = "task_key") -> DataFrame:
    """One row: links before and after, and whether some were lost."""
    a = before.agg(F.count(link).alias("linked_before"))
    b = after.agg(F.count(link).alias("linked_after"))
    return _side_by_side(a, b).withColumn("dropped", F.col("linked_after") < F.col("linked_before"))


def require_links(before: DataFrame, after: DataFrame, link: str = "task_key") -> None:
    """Raises when links were lost."""
    row = check_links(before, after, link).first()
    if row["dropped"]:
        raise RuntimeError(f"links lost: {row['linked_before']} before, {row['linked_after']} after")


def first_keys(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The first ``n`` keys in order as one text, and how many there are."""
    head = df.select(F.col(key).cast("string").alias("_k")).orderBy("_k").limit(n)
    text = head.agg(F.array_join(F.array_sort(F.collect_list("_k")), ", ").alias("keys"))
    return _side_by_side(df.agg(F.count("*").alias("n")), text)


def high_water(df: DataFrame, key: str, tag: Column) -> DataFrame:
    """Highest key under a tag, 0 when there is none."""
    return df.agg(F.coalesce(F.max(F.when(tag, F.col(key))), F.lit(0)).cast("long").alias("high_water"))


def recent(df: DataFrame, n: int = 10) -> DataFrame:
    """Latest runs, unfinished ones last, message cut to 200 characters."""
    return (
        df.withColumn("message", F.substring("message", 1, 200))
        .orderBy(F.col("finished_at").desc_nulls_last(), F.col("id").desc())
        .limit(n)
    )
