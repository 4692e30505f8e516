"""Feature loads: full reload, link-preserving load, derived polygons, rebuilt layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosync.functions import geom as g
from geosync.functions.text import is_true
from geosync.operators import audit, layers, links, merge, purge
from geosync.operators.numbering import number_rows
from geosync.plans.items import Service, sync_layer_items
from geosync.session import cut_lineage
from geosync.sources.geojson import typed_features


@dataclass(frozen=True)
class PurgeRule:
    """``column`` holds a text date (``date``) or a year (``year``)."""

    column: str
    kind: str


def apply_rule(table: DataFrame, rule: PurgeRule | None, as_of: Column) -> DataFrame:
    """Table tagged by a rule; without a rule every row is kept."""
    if rule is None:
        return merge.delete_where(table, F.lit(False))
    rules = {"date": purge.purge_date, "year": purge.purge_year}
    return rules[rule.kind](table, rule.column, as_of)


def load_reload(features: DataFrame, rule: PurgeRule | None, as_of: Column,
                order: list[str] = ("ord",)) -> tuple[DataFrame, DataFrame]:
    """New table from ``properties``, ``geom`` and the ``order`` columns, and its row counts by action."""
    typed, _ = typed_features(features)
    numbered = merge.replace_all(typed, [F.col(c) for c in order]).drop(*order)
    tagged = cut_lineage(apply_rule(numbered.withColumn("loaded_at", as_of.cast("timestamp")), rule, as_of))
    return merge.settle(tagged), merge.count_actions(tagged)


def add_derived(table: DataFrame, numbered_up_to: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Table with the polygons derived from its lines, under new ids, and the counts by outcome.

    New ids follow the highest one of ``numbered_up_to``, a frame that still has the rows just deleted.
    """
    tried = cut_lineage(layers.derive_polygons(table))
    made = tried.filter("outcome = 'derived'").drop("outcome")
    grown = _append_numbered(table, made, ["derived_from_id", "part_no"], numbered_up_to)
    return grown, tried.groupBy("outcome").agg(F.count("*").alias("n"))


def _append_numbered(table: DataFrame, new: DataFrame, order: list[str], numbered_up_to: DataFrame | None) -> DataFrame:
    """Adds rows with the ids after the highest one."""
    top = merge.highest_id(table if numbered_up_to is None else numbered_up_to)
    numbered = number_rows(new, [], [F.col(c) for c in order], "_n")
    fresh = numbered.withColumn("id", F.col("_n") + top)
    keep = [c for c in fresh.columns if c in table.columns]
    return table.unionByName(fresh.select(*keep), allowMissingColumns=True)


def rebuild_layers(table: DataFrame, old: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Layer rows rebuilt from a feature table, links kept, and the split counts.

    Linked rows and rows of frozen parents stay; all others are made anew from the open parents.
    """
    split = cut_lineage(layers.split_layers(table))
    frozen = table.filter(is_true(F.col("tasked"))).select(F.col("id").alias("_frozen"))
    kept = old.join(frozen, F.col("source_id") == F.col("_frozen"), "left_semi").unionByName(
        old.filter("task_key IS NOT NULL").join(frozen, F.col("source_id") == F.col("_frozen"), "left_anti")
    )
    made = (
        split.filter("layer IS NOT NULL")
        .withColumn("geom_hash", g.geom_hash(F.col("geom")))
        .withColumn("task_key", F.lit(None).cast("string"))
    )
    # New ids follow the highest old one, dropped rows included, so that no id comes back.
    numbered = number_rows(made, [], [F.col("layer"), F.col("source_id"), F.col("part_no")], "_n")
    fresh = numbered.withColumn("id", F.col("_n") + merge.highest_id(old))
    drop = [c for c in ("_n", "part_no", "from_collection", "geom_status") if c in fresh.columns]
    rows = kept.unionByName(fresh.drop(*drop), allowMissingColumns=True)
    saved = old.filter("task_key IS NOT NULL").select("task_key", "global_id", "geom_hash", F.col("id").alias("old_id"))
    restored = links.restore_links(cut_lineage(rows), saved)
    return restored.drop("action"), layers.split_counts(split)


def load_preserving(features: DataFrame, target: DataFrame, old_layers: DataFrame, items: DataFrame, service: Service,
                    rule: PurgeRule | None, as_of: Column, order: str = "ord",
                    areas: DataFrame | None = None) -> dict[str, DataFrame]:
    """A load that keeps ids and links: upsert, delete absent, purge, derive, split, link, tag with ``areas``, check.

    Raises when links were lost. Returns ``table``, ``layers``, ``items`` and the counts of each step.
    """
    typed, _ = typed_features(features)
    changes = cut_lineage(typed.withColumn("geom_hash", g.geom_hash(F.col("geom"))))
    known = merge.evolve(target, changes.drop(order).limit(0))
    if "global_id" not in changes.columns:
        changes = changes.withColumn("global_id", F.lit(None).cast("bigint"))
    merged = cut_lineage(merge.delete_absent(merge.match_upsert(known, changes, [F.col(order)])))
    # Loaded rows get the time of the load; rows that were left alone keep theirs.
    written = F.col("action").isin("insert", "update")
    stamped = merged.withColumn(
        "loaded_at", F.when(written, as_of.cast("timestamp")).otherwise(F.col("loaded_at"))
    )
    purged = cut_lineage(apply_rule(merge.settle(stamped), rule, as_of))
    table, derived = add_derived(merge.settle(purged), merged)
    table = cut_lineage(table)
    rebuilt, split = rebuild_layers(table, old_layers)
    synced = sync_layer_items(cut_lineage(rebuilt), items, table, service, as_of, areas)
    audit.require_links(old_layers, synced["layers"])
    return {
        "table": synced["parents"],
        "layers": synced["layers"],
        "items": synced["items"],
        "merge_counts": merge.count_actions(merged),
        "purge_counts": merge.count_actions(purged),
        "derive_counts": derived,
        "split_counts": split,
        "sync_counts": synced["counts"],
    }

