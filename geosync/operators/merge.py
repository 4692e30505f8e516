"""Write modes as functions from a target and its changes to the new target.

Each mode returns the full result with an ``action`` column where rows are told apart. ``settle``
gives the rows to write, ``count_actions`` the numbers to report, both from the same plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosync.functions.text import is_distinct
from geosync.operators.keep import first_per, last_wins
from geosync.operators.numbering import number_rows


def settle(tagged: DataFrame) -> DataFrame:
    """Rows of the new target: everything that was not deleted."""
    return tagged.filter(F.col("action") != "delete").drop("action")


def count_actions(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("action").agg(F.count("*").alias("n"))


def _equal(keys: list[str], left: str = "t", right: str = "s") -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(f"{left}.`{key}`") == F.col(f"{right}.`{key}`"))
    return same


def _complete(keys) -> Column:
    """Every key column has a value."""
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return whole


def _marked(df: DataFrame, alias: str) -> DataFrame:
    return df.withColumn("_here", F.lit(True)).alias(alias)


def replace_all(new: DataFrame, order: list[Column], id_col: str = "id") -> DataFrame:
    """Full replace: the new rows alone, numbered from 1 in ``order``."""
    return number_rows(new.drop(id_col), [], order, id_col)


def highest_id(df: DataFrame, id_col: str = "id") -> int:
    """Highest id in use, 0 when there is none."""
    return df.agg(F.max(id_col)).first()[0] or 0


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], order: list[Column],
           when: Column | None = None, keep_non_null: list[str] | None = None) -> DataFrame:
    """Insert or update by key, the last change per key winning.

    ``when`` tests the old row (as ``t``) and lets it stand when not true; columns in
    ``keep_non_null`` keep the old value where the change has none. Columns the changes lack stay.
    """
    # A NULL key meets nothing. Such rows are left out of the join, where they would all land in one
    # task, and put back after it.
    lone_changes = changes.filter(~_complete(keys)).select(*[c for c in target.columns if c in changes.columns])
    lone_targets = target.filter(~_complete(keys))
    last = last_wins(changes.filter(_complete(keys)), keys, order)
    joined = _marked(target.filter(_complete(keys)), "t").join(_marked(last, "s"), _equal(keys), "full_outer")
    old, new = F.col("t._here").isNotNull(), F.col("s._here").isNotNull()
    allowed = F.lit(True) if when is None else F.coalesce(when, F.lit(False))
    written = new & (~old | allowed)
    columns = []
    for c in target.columns:
        if c not in changes.columns:
            columns.append(F.col(f"t.`{c}`").alias(c))
            continue
        value = F.col(f"s.`{c}`")
        if c in (keep_non_null or []):
            value = F.coalesce(value, F.col(f"t.`{c}`"))
        columns.append(F.when(written, value).otherwise(F.col(f"t.`{c}`")).alias(c))
    action = (
        F.when(new & ~old, F.lit("insert")).when(written, F.lit("update")).otherwise(F.lit("keep"))
    )
    merged = joined.select(*columns, action.alias("action"))
    return merged.unionByName(lone_targets.withColumn("action", F.lit("keep"))).unionByName(
        lone_changes.withColumn("action", F.lit("insert")), allowMissingColumns=True
    )


def insert_absent(target: DataFrame, changes: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Insert changes whose key the target lacks; the first change per key wins, the target stands.

    A key with a NULL meets nothing, so such changes are all inserted.
    """
    once = first_per(changes.filter(_complete(keys)), [F.col(k) for k in keys], order)
    fresh = once.alias("s").join(target.select(*keys).alias("t"), _equal(keys), "left_anti")
    fresh = fresh.unionByName(changes.filter(~_complete(keys)))
    return target.withColumn("action", F.lit("keep")).unionByName(
        fresh.select(*[c for c in target.columns if c in once.columns]).withColumn("action", F.lit("insert")),
        allowMissingColumns=True,
    )


def insert_only(target: DataFrame, changes: DataFrame, keys: list[str],
                order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Insert new keys; the second frame holds the changes refused because their key was there
    already, in the target or earlier in the changes. Changes with a NULL in the key are never refused.

    Of changes with one key and equal ``order`` the one with the least other values counts; of equal rows one."""
    lone = changes.filter(~_complete(keys))
    columns = [F.col(f"`{c}`") for c in changes.columns]
    # equal rows are one with their number, so that one of them can be inserted and the others refused
    counted = changes.filter(_complete(keys)).groupBy(*columns).agg(F.count("*").alias("_copies"))
    ranked = counted.withColumn("_order", F.struct(*order, *columns))
    first = ranked.groupBy(*keys).agg(F.min("_order").alias("_first"))
    known = target.filter(_complete(keys)).select(*keys).distinct().withColumn("_known", F.lit(True))
    judged = ranked.join(first, keys).join(known, keys, "left")
    inserted = F.col("_known").isNull() & F.col("_order").eqNullSafe(F.col("_first"))
    left = F.col("_copies") - F.when(inserted, 1).otherwise(0)
    refused = judged.filter(left > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), left))).select(*columns)
    fresh = judged.filter(inserted).select(*columns).unionByName(lone)
    added = target.unionByName(
        fresh.select(*[c for c in target.columns if c in fresh.columns]), allowMissingColumns=True
    )
    return added, refused


def mirror(target: DataFrame, source: DataFrame, key: str, compare: list[str],
           delete_missing: bool = True, order: list[Column] | None = None) -> DataFrame:
    """Three-way merge: delete what the source lost, update what differs, insert what is new.

    Columns only the target has keep their values. Of source rows with one key the last in ``order`` counts, without
    an order the greatest by ``compare``.
    """
    source = last_wins(source, [key], order or [F.col(c) for c in compare])
    joined = _marked(target, "t").join(_marked(source, "s"), _equal([key]), "full_outer")
    old, new = F.col("t._here").isNotNull(), F.col("s._here").isNotNull()
    differs = is_distinct(
        F.struct(*[F.col(f"t.`{c}`") for c in compare]), F.struct(*[F.col(f"s.`{c}`") for c in compare])
    )
    action = (
        F.when(~new, F.lit("delete" if delete_missing else "keep"))
        .when(~old, F.lit("insert"))
        .when(differs, F.lit("update"))
        .otherwise(F.lit("unchanged"))
    )
    owned = {key, *compare}
    columns = [
        (F.when(new, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")) if c in owned else F.col(f"t.`{c}`")).alias(c)
        for c in target.columns
    ]
    return joined.select(*columns, action.alias("action"))


def match_upsert(target: DataFrame, changes: DataFrame, order: list[Column], match: tuple[str, str] =
                 ("global_id", "geom_hash"), frozen: str = "tasked", id_col: str = "id") -> DataFrame:
    """Upsert that keeps ids: a change takes the lowest id with the same business id and geometry hash.

    Frozen rows are matched but not written. Changes without both match columns are always new, and
    new rows get the ids after the highest one, in ``order``. ``action`` is ``insert``, ``update``,
    ``frozen`` or ``unseen`` (a target row no change matched).
    """
    found = target.filter(_complete(match)).groupBy(*match).agg(F.min(id_col).alias("_id"))
    last = last_wins(changes.filter(_complete(match)), list(match), order).drop(id_col)
    matched = last.join(found, list(match), "left")
    hit = matched.filter(F.col("_id").isNotNull()).withColumnRenamed("_id", id_col)
    # Changes that cannot match stay out of the join, where they would all land in one task.
    lone = changes.filter(~_complete(match)).drop(id_col)
    unmatched = matched.filter(F.col("_id").isNull()).drop("_id").unionByName(lone)
    new = number_rows(unmatched, [], order, "_nr")
    fresh = new.withColumn(id_col, F.col("_nr") + highest_id(target, id_col)).drop("_nr")

    joined = _marked(target, "t").join(_marked(hit, "s"), _equal([id_col]), "left")
    seen = F.col("s._here").isNotNull()
    is_frozen = F.coalesce(F.col(f"t.`{frozen}`"), F.lit(False))
    columns = [
        (
            F.when(seen & ~is_frozen, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`"))
            if c in changes.columns and c not in (id_col, frozen)
            else F.col(f"t.`{c}`")
        ).alias(c)
        for c in target.columns
    ]
    action = (
        F.when(~seen, F.lit("unseen")).when(is_frozen, F.lit("frozen")).otherwise(F.lit("update"))
    )
    kept = joined.select(*columns, action.alias("action"))
    added = fresh.select(*[c for c in target.columns if c in fresh.columns and c != frozen]).withColumn(
        "action", F.lit("insert")
    )
    merged = kept.unionByName(added, allowMissingColumns=True)
    return merged.withColumn(frozen, F.coalesce(F.col(frozen), F.lit(False)))


def delete_absent(tagged: DataFrame, frozen: str = "tasked") -> DataFrame:
    """Marks rows no change matched as deleted, unless they are frozen."""
    gone = (F.col("action") == "unseen") & ~F.coalesce(F.col(frozen), F.lit(False))
    return tagged.withColumn(
        "action", F.when(gone, F.lit("delete")).when(F.col("action") == "unseen", F.lit("frozen")).otherwise(F.col("action"))
    )


def update_from(target: DataFrame, source: DataFrame, on: list[str], columns: list[str],
                where: Column | None = None, order: list[Column] | None = None) -> DataFrame:
    """Sets ``columns`` from the source row with the same key; ``action`` is ``update`` or ``keep``.

    Of source rows with one key the first in ``order`` counts, without an order the least by ``columns``. So no target
    row comes out twice. ``where`` may test ``t`` and ``s``.
    """
    source = first_per(source.filter(_complete(on)), [F.col(k) for k in on], order or [F.col(c) for c in columns])
    joined = target.alias("t").join(_marked(source, "s"), _equal(on), "left")
    hit = F.col("s._here").isNotNull()
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    made = [
        (F.when(hit, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")) if c in columns else F.col(f"t.`{c}`")).alias(c)
        for c in target.columns
    ]
    return joined.select(*made, F.when(hit, F.lit("update")).otherwise(F.lit("keep")).alias("action"))


def delete_where(target: DataFrame, doomed: Column) -> DataFrame:
    """``action`` is ``delete`` where ``doomed`` is true, else ``keep``."""
    return target.withColumn(
        "action", F.when(F.coalesce(doomed, F.lit(False)), F.lit("delete")).otherwise(F.lit("keep"))
    )


def evolve(target: DataFrame, new: DataFrame) -> DataFrame:
    """Union that adds new columns and keeps the type of those the target has."""
    types = dict(target.dtypes)
    fitted = new.select(
        *[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in new.columns]
    )
    return target.unionByName(fitted, allowMissingColumns=True)


def null_missing_refs(child: DataFrame, ref: str, parent: DataFrame, key: str) -> DataFrame:
    """Links to parents that are gone become NULL."""
    alive = parent.select(F.col(key).alias("_alive")).distinct()
    joined = child.join(alive, F.col(ref) == F.col("_alive"), "left")
    return joined.withColumn(ref, F.col("_alive")).drop("_alive").select(*child.columns)
