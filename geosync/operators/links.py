"""Links between layer rows and work items, restored links, fallback matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosync.functions.text import is_not_true, is_true
from geosync.operators.keep import first_per, latest_per
from geosync.operators.numbering import number_rows


def link_once(rows: DataFrame, items: DataFrame, business_id: str, item_id: str, row_id: str = "id",
              link: str = "task_key", key: str = "key") -> DataFrame:
    """Links unlinked rows to the item with the same business id; ``action`` is ``update`` or ``keep``.

    An item already linked to a row is not linked again. Of several rows the lowest id gets it, of several free items
    with one id the lowest key is given.
    """
    taken = rows.filter(F.col(link).isNotNull()).select(F.col(link).alias("_taken")).distinct()
    named = items.filter(F.col(item_id).isNotNull()).select(F.col(item_id).alias("_bid"), F.col(key).alias("_key"))
    free = named.join(taken, F.col("_key") == F.col("_taken"), "left_anti")
    open_items = free.groupBy("_bid").agg(F.min("_key").alias("_key"))
    open_rows = rows.filter(F.col(link).isNull() & F.col("geom").isNotNull())
    chosen = (
        open_rows.groupBy(F.col(business_id).alias("_bid"))
        .agg(F.min(row_id).alias("_rid"))
        .join(open_items, "_bid")
        .select("_rid", "_key")
    )
    joined = rows.join(chosen, F.col(row_id) == F.col("_rid"), "left")
    hit = F.col("_key").isNotNull() & F.col(link).isNull()
    return joined.select(
        *[F.col(c) for c in rows.columns if c != link],
        F.when(hit, F.col("_key")).otherwise(F.col(link)).alias(link),
        F.when(hit, F.lit("update")).otherwise(F.lit("keep")).alias("action"),
    )


def restore_links(rows: DataFrame, saved: DataFrame, row_id: str = "id", link: str = "task_key",
                  match: tuple[str, str] = ("global_id", "geom_hash")) -> DataFrame:
    """Puts saved links back on rebuilt rows; ``action`` is ``update`` or ``keep``.

    ``saved`` has ``task_key``, ``global_id``, ``geom_hash`` and ``old_id``. The k-th saved key of a
    (business id, geometry hash) pair goes to the k-th unlinked row of that pair, in order of old and
    new id; a saved key without that pair goes to the row with its old id. No key is used twice.
    """
    taken = rows.filter(F.col(link).isNotNull()).select(F.col(link).alias("_taken"))
    once = first_per(saved, [F.col(link)], [F.col("old_id")])
    free = once.join(taken, F.col(link) == F.col("_taken"), "left_anti")
    paired = F.col(match[0]).isNotNull() & F.col(match[1]).isNotNull()

    ranked_keys = number_rows(
        free.filter(paired).select(*match, "old_id", F.col(link).alias("_key")),
        list(match), [F.col("old_id").asc(), F.col("_key").asc()], "_k",
    )
    slots = rows.filter(F.col(link).isNull() & paired).select(*match, F.col(row_id).alias("_rid"))
    ranked_slots = number_rows(slots, list(match), [F.col("_rid").asc()], "_k")
    by_pair = ranked_keys.join(ranked_slots, [*match, "_k"]).select("_rid", "_key")

    lone = free.filter(~paired).groupBy(F.col("old_id").alias("_rid")).agg(F.min(link).alias("_key"))
    by_id = lone.join(by_pair.select("_rid"), "_rid", "left_anti")
    chosen = by_pair.unionByName(by_id.select("_rid", "_key"))
    joined = rows.join(chosen, F.col(row_id) == F.col("_rid"), "left")
    hit = F.col("_key").isNotNull() & F.col(link).isNull()
    return joined.select(
        *[F.col(c) for c in rows.columns if c != link],
        F.when(hit, F.col("_key")).otherwise(F.col(link)).alias(link),
        F.when(hit, F.lit("update")).otherwise(F.lit("keep")).alias("action"),
    )


def fallback_match(source: DataFrame, target: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """Tags each source row ``first``, ``second`` or ``missing`` by where its key is found.

    The second column counts only when the first holds the key nowhere.
    """
    a = target.select(F.col(first).alias("_a")).filter("_a IS NOT NULL").distinct()
    b = target.select(F.col(second).alias("_b")).filter("_b IS NOT NULL").distinct()
    joined = source.join(a, F.col(key) == F.col("_a"), "left").join(b, F.col(key) == F.col("_b"), "left")
    how = (
        F.when(F.col("_a").isNotNull(), F.lit("first"))
        .when(F.col("_b").isNotNull(), F.lit("second"))
        .otherwise(F.lit("missing"))
    )
    return joined.withColumn("match", how).drop("_a", "_b")


def apply_fallback(target: DataFrame, matched: DataFrame, key: str, first: str, second: str,
                   columns: list[str]) -> DataFrame:
    """Target with ``columns`` set from the matched source rows; ``action`` tells updated rows."""
    by_first = matched.filter("match = 'first'").select(
        F.col(key).alias("_k1"), *[F.col(c).alias(f"_1{c}") for c in columns]
    )
    by_second = matched.filter("match = 'second'").select(
        F.col(key).alias("_k2"), *[F.col(c).alias(f"_2{c}") for c in columns]
    )
    joined = target.join(by_first, F.col(first) == F.col("_k1"), "left").join(
        by_second, F.col(second) == F.col("_k2"), "left"
    )
    hit = F.col("_k1").isNotNull() | F.col("_k2").isNotNull()
    made = [
        (
            F.when(F.col("_k1").isNotNull(), F.col(f"_1{c}"))
            .when(F.col("_k2").isNotNull(), F.col(f"_2{c}"))
            .otherwise(F.col(c))
            if c in columns
            else F.col(c)
        ).alias(c)
        for c in target.columns
    ]
    return joined.select(*made, F.when(hit, F.lit("update")).otherwise(F.lit("keep")).alias("action"))


def eligible_items(items: DataFrame, photos: DataFrame, photo_id: str, owner: str = "etl") -> DataFrame:
    """Newest item per camera that the loader owns and nobody has observed: ``cam_id``, ``key``."""
    own = items.filter(
        is_not_true(F.col("field_observed")) & is_true(F.array_contains(F.col("user_last_edit"), owner))
    ).select("key", F.col(photo_id).alias("_photo"))
    cameras = photos.filter(F.col("cam_id").isNotNull()).select(F.col("uuid").alias("_photo"), "cam_id")
    return own.join(cameras, "_photo").groupBy("cam_id").agg(F.max("key").alias("key"))


def latest_photos(photos: DataFrame, key: Column) -> DataFrame:
    """Newest photo per key, by id."""
    return latest_per(photos, [key], [F.col("id")])


def pending(ids: DataFrame, meta: DataFrame | None, key: str = "uuid", done: str = "done") -> DataFrame:
    """Ids without finished metadata; the test adapts to the columns the metadata has."""
    if meta is None or key not in meta.columns:
        return ids
    if "status" in meta.columns:
        # One row per id on the right: an id counts as open when any of its rows is not done.
        state = meta.filter(F.col(key).isNotNull()).groupBy(key).agg(
            F.bool_or(~F.col("status").eqNullSafe(F.lit(done))).alias("_open")
        )
    else:
        state = meta.filter(F.col(key).isNotNull()).select(key).distinct().withColumn("_open", F.lit(False))
    joined = ids.join(state, [key], "left")
    return joined.filter(F.coalesce(F.col("_open"), F.lit(True))).drop("_open")


def retry_pending(waiting: DataFrame, outcomes: DataFrame, key: str = "uuid") -> tuple[DataFrame, DataFrame]:
    """What still waits after the outcomes (``done``, ``failed``, ``not_ready``), and outcome counts."""
    settled = outcomes.filter("outcome IN ('done', 'failed')").select(key).distinct()
    return waiting.join(settled, [key], "left_anti"), outcomes.groupBy("outcome").agg(F.count("*").alias("n"))


def union_ids(*sources: DataFrame) -> DataFrame:
    """Distinct non-blank ids of several one-column frames, as ``id``."""
    every = None
    for source in sources:
        ids = source.select(F.col(source.columns[0]).cast("string").alias("id"))
        every = ids if every is None else every.unionByName(ids)
    return every.filter(F.trim("id") != "").distinct()


def new_ids(found: DataFrame, *known: DataFrame) -> DataFrame:
    """Distinct found ids that no known list holds."""
    fresh = union_ids(found)
    for other in known:
        fresh = fresh.join(union_ids(other), "id", "left_anti")
    return fresh


def orphans(items: DataFrame, children: DataFrame, id_columns: list[str], link: str = "task_key") -> DataFrame:
    """Scoped items that neither field nor office made and no child links to."""
    scoped = F.lit(False)
    for c in id_columns:
        scoped = scoped | is_true(F.col(c).rlike("^(point|line|polygon):"))
    made = items.filter(
        is_not_true(F.col("is_field_data")) & is_not_true(F.col("is_office_task")) & scoped
    )
    return made.join(children.filter(F.col(link).isNotNull()), F.col("key") == F.col(link), "left_anti")


def unique_names(df: DataFrame, name: str) -> DataFrame:
    """Adds ``name_unique``: whether the name occurs once. A blank name is not unique."""
    counts = df.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("_n"))
    joined = df.join(counts, [name], "left")
    return joined.withColumn("name_unique", F.coalesce(F.col("_n") == 1, F.lit(False))).drop("_n")
