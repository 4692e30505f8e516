"""Queries over write modes, joins, counts, windows and sets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from geosync.contract import bindings as b
from geosync.contract.registry import TABLES, Tables, query, sub
from geosync.functions.text import blank_to_null, legacy_name
from geosync.operators import audit, guards, keep, links, merge, numbering
from geosync.session import cut_lineage, shared_folder, stage
from geosync.sources import runlog, tables

c = F.col
TARGET, SOURCE = sub(b.MIRROR_TARGET), sub(b.MIRROR_SOURCE)
LAYERS, ITEMS, PHOTOS = sub(b.LAYER_ROWS), sub(b.ITEMS), sub(b.PHOTOS)

# --- scans -------------------------------------------------------------------------------------


@query("snapshot_scan", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def snapshot_scan(t: Tables):
    return tables.read_table(t.spark, t.folder, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])


@query("highwater_incremental", "SELECT event_id, event_type FROM events WHERE event_id > (SELECT coalesce(max(event_id), 0) FROM events WHERE event_type = 'click' AND user_id < 20)")
def highwater_incremental(t: Tables):
    tag = (c("event_type") == "click") & (c("user_id") < 20)
    last = audit.high_water(t.events, "event_id", tag).first()["high_water"]
    return tables.read_incremental(t.events, "event_id", last).select("event_id", "event_type")


@query("highwater_max", "SELECT event_type, CAST(coalesce(max(CASE WHEN user_id > 50 THEN event_id END), 0) AS BIGINT) AS high_water FROM events GROUP BY event_type")
def highwater_max(t: Tables):
    mark = F.max(F.when(c("user_id") > 50, c("event_id")))
    return t.events.groupBy("event_type").agg(F.coalesce(mark, F.lit(0)).cast("long").alias("high_water"))


@query("keylist_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def keylist_scan(t: Tables):
    keys = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    return tables.read_by_keys(t.orders, "o_custkey", keys).select("o_orderkey", "o_totalprice")


@query("missing_keys", "SELECT DISTINCT c_custkey * 2 AS o_custkey FROM customer WHERE c_custkey * 2 NOT IN (SELECT o_custkey FROM orders)")
def missing_keys(t: Tables):
    return tables.missing_keys(t.customer.select((c("c_custkey") * 2).alias("k")), t.orders, "o_custkey")


_SYNCED = TABLES


@query("schema_sync_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in _SYNCED))
def schema_sync_counts(t: Tables):
    return tables.sync_schema(t.spark, t.folder, list(_SYNCED), f"{shared_folder(t.spark)}/synced-{uuid.uuid4().hex}")


# --- write modes -------------------------------------------------------------------------------


@query("full_replace", "SELECT row_number() OVER (ORDER BY c_name, c_custkey) AS id, c_name, c_mktsegment FROM customer")
def full_replace(t: Tables):
    return merge.replace_all(t.customer, [c("c_name").asc(), c("c_custkey").asc()]).select("id", "c_name", "c_mktsegment")


_LAST = "SELECT cam_id, arg_max(id, id) AS id, arg_max(status, id) AS status FROM {p} GROUP BY cam_id".replace("{p}", PHOTOS)


@query("keyed_upsert", f"""WITH s AS ({_LAST}), t AS (SELECT c_custkey AS cam_id, c_name AS status, CAST(c_nationkey AS BIGINT) AS id, c_mktsegment AS note FROM customer)
SELECT coalesce(t.cam_id, s.cam_id) AS cam_id, coalesce(s.status, t.status) AS status, coalesce(s.id, t.id) AS id, t.note,
CASE WHEN t.cam_id IS NULL THEN 'insert' WHEN s.cam_id IS NOT NULL THEN 'update' ELSE 'keep' END AS action FROM t FULL JOIN s ON t.cam_id = s.cam_id""")
def keyed_upsert(t: Tables):
    target = t.customer.select(
        c("c_custkey").alias("cam_id"), c("c_name").alias("status"), c("c_nationkey").cast("long").alias("id"),
        c("c_mktsegment").alias("note"),
    )
    changes = t.bind(b.PHOTOS).select("cam_id", "status", "id")
    return merge.upsert(target, changes, ["cam_id"], [c("id")])


@query("conditional_upsert", f"""WITH s AS ({_LAST}), t AS (SELECT c_custkey AS cam_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'uploaded' ELSE 'failed' END AS status, CAST(c_nationkey AS BIGINT) AS id, c_name AS uuid FROM customer)
SELECT coalesce(t.cam_id, s.cam_id) AS cam_id, CASE WHEN s.cam_id IS NULL OR t.status = 'uploaded' THEN t.status ELSE s.status END AS status,
CASE WHEN s.cam_id IS NULL OR t.status = 'uploaded' THEN t.id ELSE s.id END AS id, CASE WHEN t.cam_id IS NULL THEN CASE WHEN s.id % 2 = 0 THEN 'n' || s.id END
 WHEN t.status = 'uploaded' OR s.cam_id IS NULL OR s.id % 2 = 1 THEN t.uuid ELSE 'n' || s.id END AS uuid,
CASE WHEN t.cam_id IS NULL THEN 'insert' WHEN s.cam_id IS NOT NULL AND t.status <> 'uploaded' THEN 'update' ELSE 'keep' END AS action FROM t FULL JOIN s ON t.cam_id = s.cam_id""")
def conditional_upsert(t: Tables):
    state = F.when(c("c_mktsegment") == "BUILDING", F.lit("uploaded")).otherwise(F.lit("failed"))
    target = t.customer.select(
        c("c_custkey").alias("cam_id"), state.alias("status"), c("c_nationkey").cast("long").alias("id"), c("c_name").alias("uuid")
    )
    uuid = F.when(c("id") % 2 == 0, F.concat(F.lit("n"), c("id")))
    changes = t.bind(b.PHOTOS).select("cam_id", "status", "id", uuid.alias("uuid"))
    open_row = ~c("t.status").eqNullSafe(F.lit("uploaded"))
    return merge.upsert(target, changes, ["cam_id"], [c("id")], when=open_row, keep_non_null=["uuid"])




@query("match_upsert", """
WITH t AS (SELECT o_orderkey AS id, o_custkey AS global_id, md5(o_orderstatus) AS geom_hash, o_orderpriority AS attr, o_orderpriority = '1-URGENT' AS tasked FROM orders WHERE o_orderpriority <> '5-LOW'),
s AS (SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_custkey END AS global_id, md5(o_orderstatus) AS geom_hash, o_clerk AS attr, o_orderkey AS ord FROM (SELECT *, 'n' || o_orderkey AS o_clerk FROM orders)),
l AS (SELECT global_id, geom_hash, arg_max(attr, ord) AS attr, max(ord) AS ord FROM s WHERE global_id IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT global_id, geom_hash, attr, ord FROM s WHERE global_id IS NULL),
f AS (SELECT global_id, geom_hash, min(id) AS id FROM t GROUP BY 1, 2),
m AS (SELECT l.*, f.id FROM l LEFT JOIN f ON l.global_id = f.global_id AND l.geom_hash = f.geom_hash),
n AS (SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY ord) AS id, global_id, geom_hash, attr FROM m WHERE id IS NULL)
SELECT t.id, t.global_id, t.geom_hash, CASE WHEN m.id IS NOT NULL AND NOT t.tasked THEN m.attr ELSE t.attr END AS attr, t.tasked,
 CASE WHEN m.id IS NULL THEN 'unseen' WHEN t.tasked THEN 'frozen' ELSE 'update' END AS action FROM t LEFT JOIN m ON t.id = m.id
UNION ALL SELECT id, global_id, geom_hash, attr, false, 'insert' FROM n""")
def match_upsert(t: Tables):
    return _matched(t)


def _matched(t: Tables):
    target = t.orders.filter("o_orderpriority <> '5-LOW'").select(
        c("o_orderkey").alias("id"), c("o_custkey").alias("global_id"), F.md5("o_orderstatus").alias("geom_hash"),
        c("o_orderpriority").alias("attr"), (c("o_orderpriority") == "1-URGENT").alias("tasked"),
    )
    changes = t.orders.select(
        F.when(c("o_orderpriority") != "4-NOT SPECIFIED", c("o_custkey")).alias("global_id"),
        F.md5("o_orderstatus").alias("geom_hash"), F.concat(F.lit("n"), c("o_orderkey")).alias("attr"), c("o_orderkey").alias("ord"),
    )
    return merge.match_upsert(target, changes, [c("ord")])


@query("delete_absent", """
WITH t AS (SELECT o_orderkey AS id, o_custkey AS global_id, o_orderstatus AS h, o_orderpriority = '1-URGENT' AS tasked FROM orders WHERE o_orderpriority <> '5-LOW'),
s AS (SELECT o_custkey AS global_id, o_orderstatus AS h FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED' GROUP BY 1, 2),
f AS (SELECT min(t.id) AS id FROM t JOIN s ON t.global_id = s.global_id AND t.h = s.h GROUP BY t.global_id, t.h)
SELECT t.id, CASE WHEN f.id IS NOT NULL THEN CASE WHEN tasked THEN 'frozen' ELSE 'update' END WHEN tasked THEN 'frozen' ELSE 'delete' END AS action FROM t LEFT JOIN f ON t.id = f.id""")
def delete_absent(t: Tables):
    return merge.delete_absent(_matched(t)).filter("action <> 'insert'").select("id", "action")


@query("insert_if_absent", f"""SELECT DISTINCT 'label' AS type, label_id FROM {ITEMS} WHERE label_id IS NOT NULL
UNION ALL SELECT 'new', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 7 <> 0 AND CAST(c_custkey AS VARCHAR) NOT IN (SELECT label_id FROM {ITEMS} WHERE label_id IS NOT NULL)
UNION ALL SELECT 'new', NULL FROM customer WHERE c_custkey % 7 = 0""")
def insert_if_absent(t: Tables):
    target = t.bind(b.ITEMS).filter("label_id IS NOT NULL").select(F.lit("label").alias("type"), "label_id")
    changes = t.customer.select(F.lit("new").alias("type"), F.when(c("c_custkey") % 7 != 0, c("c_custkey").cast("string")).alias("label_id"))
    return merge.insert_absent(target, changes, ["label_id"], [c("type")]).drop("action")


@query("insert_only_conflicts", """WITH s AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id, copy) AS rn
FROM events, (SELECT unnest([0, 1, 2]) AS copy) WHERE event_id % 11 <> 0 AND (copy = 0 OR event_id % 5 = 0))
SELECT event_id, user_id, event_type FROM s WHERE rn > 1 OR user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def insert_only_conflicts(t: Tables):
    # Many changes of a user have one kind, by which they are ordered, and every fifth comes three times.
    target = t.customer.filter("c_mktsegment = 'BUILDING'").select(c("c_custkey").alias("user_id"))
    changes = t.events.select(F.when(c("event_id") % 11 != 0, c("user_id")).alias("user_id"), "event_id", "event_type")
    again = changes.filter("event_id % 5 = 0")
    _, refused = merge.insert_only(target, changes.unionAll(again).unionAll(again), ["user_id"], [c("event_type")])
    return refused.select("event_id", "user_id", "event_type")


_COMPARE = ["o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]
_DIFF = " OR ".join(f"t.{x} IS DISTINCT FROM s.{x}" for x in _COMPARE)
_ACTION = f"CASE WHEN s.id IS NULL THEN 'delete' WHEN t.id IS NULL THEN 'insert' WHEN {_DIFF} THEN 'update' ELSE 'unchanged' END"


def _mirrored(t: Tables):
    return merge.mirror(t.bind(b.MIRROR_TARGET), t.bind(b.MIRROR_SOURCE), "id", _COMPARE)


@query("mirror_merge", f"""SELECT s.id, s.o_custkey, s.o_totalprice, s.o_orderstatus, s.o_orderpriority, t.local_note FROM {SOURCE} s LEFT JOIN {TARGET} t ON s.id = t.id""")
def mirror_merge(t: Tables):
    return merge.settle(_mirrored(t))


@query("mirror_merge_counts", f"SELECT {_ACTION} AS action, count(*) AS n FROM {TARGET} t FULL JOIN {SOURCE} s ON t.id = s.id GROUP BY 1")
def mirror_merge_counts(t: Tables):
    return merge.count_actions(_mirrored(t))


@query("dry_run_counts", f"SELECT CASE WHEN s.id IS NULL THEN 'keep' WHEN t.id IS NULL THEN 'insert' WHEN {_DIFF} THEN 'update' ELSE 'unchanged' END AS action, count(*) AS n FROM {TARGET} t FULL JOIN {SOURCE} s ON t.id = s.id GROUP BY 1")
def dry_run_counts(t: Tables):
    partial = merge.mirror(t.bind(b.MIRROR_TARGET), t.bind(b.MIRROR_SOURCE), "id", _COMPARE, delete_missing=False)
    return merge.count_actions(partial)


@query("update_from_join", """SELECT c_custkey, coalesce(n, CAST(c_nationkey AS BIGINT)) AS n, CASE WHEN n IS NULL THEN 'keep' ELSE 'update' END AS action
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey AND c_acctbal > 0""")
def update_from_join(t: Tables):
    target = t.customer.select("c_custkey", c("c_nationkey").cast("long").alias("n"), "c_acctbal")
    counts = t.orders.filter("o_orderstatus = 'F'").groupBy(c("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    doubled = counts.unionByName(counts.withColumn("n", c("n") + 5))
    return merge.update_from(target, doubled, ["c_custkey"], ["n"], c("t.c_acctbal") > 0).drop("c_acctbal")


@query("schema_evolve", """SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS brand FROM customer
UNION ALL SELECT p_partkey, p_name, TRY_CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT), p_brand FROM part""")
def schema_evolve(t: Tables):
    target = t.customer.select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_nationkey").cast("long").alias("size"))
    new = t.part.select(
        c("p_partkey").alias("id"), c("p_name").alias("name"), F.regexp_extract("p_brand", "([0-9]+)", 1).alias("size"),
        c("p_brand").alias("brand"),
    )
    return merge.evolve(target, new)


@query("guarded_delete", f"""SELECT key, CASE WHEN NOT is_field_data THEN 'keep' WHEN owner = 'etl' THEN 'blocked' ELSE 'delete' END AS action FROM {ITEMS}""")
def guarded_delete(t: Tables):
    items = t.bind(b.ITEMS).withColumn("user_created", F.array("owner", "key"))
    tagged, _ = guards.guarded_delete(items, items.filter("is_field_data"))
    return tagged.select("key", "action")


@query("cascade_set_null", "SELECT o_orderkey, c_custkey AS o_custkey FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey")
def cascade_set_null(t: Tables):
    parents = t.customer.filter("c_mktsegment <> 'BUILDING'")
    return merge.null_missing_refs(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", parents, "c_custkey")


_SNAP = "SELECT l_returnflag AS status, concat('t', lpad(CAST(l_orderkey AS STRING), 10, '0')) AS task_key FROM {lineitem}"


@query("snapshot_clear", f"""WITH s AS {sub(_SNAP)}, w AS (SELECT DISTINCT key FROM {ITEMS} WHERE permit_id IS NOT NULL)
SELECT status, count(*) AS before, count(key) AS deleted, count(*) - count(key) AS "left", (SELECT count(*) FROM {ITEMS} WHERE permit_id IS NOT NULL) AS items FROM s LEFT JOIN w ON task_key = key GROUP BY status""")
def snapshot_clear(t: Tables):
    items = t.bind(b.ITEMS)
    keys = items.filter("permit_id IS NOT NULL").select(c("key").alias("task_key"))
    kept, report = guards.clear_snapshots(t.bind(_SNAP), keys, items)
    report, before = cut_lineage(report), guards.items_state(items, keys)
    guards.check_cleared(report, before, stage(kept, "snapshots"), keys, items)
    return report


@query("flag_reset", f"SELECT CASE WHEN field_observed IS DISTINCT FROM false THEN 'update' ELSE 'keep' END AS action, count(*) AS n, count(*) FILTER (WHERE false) AS still_set FROM {ITEMS} GROUP BY 1")
def flag_reset(t: Tables):
    reset = guards.reset_flag(t.bind(b.ITEMS), "field_observed")
    return reset.groupBy("action").agg(F.count("*").alias("n"), F.count_if(c("field_observed")).alias("still_set"))


_RUNS = "SELECT concat('r', CAST(user_id AS STRING)) AS run_id, event_type AS job_name, CASE WHEN event_id % 3 = 0 THEN 'running' ELSE 'success' END AS status, concat('m', CAST(event_id AS STRING)) AS message, event_id AS rows_affected, event_id * 1e0 AS logged_at FROM {events}"


@query("run_log_latest", f"""SELECT run_id, arg_max(job_name, logged_at) AS job_name, arg_max(status, logged_at) AS status, arg_max(message, logged_at) AS message, arg_max(rows_affected, logged_at) AS rows_affected,
min(logged_at) AS started_at, max(CASE WHEN status <> 'running' THEN logged_at END) AS finished_at FROM {sub(_RUNS)} GROUP BY run_id""")
def run_log_latest(t: Tables):
    return runlog.runs(t.bind(_RUNS))


@query("recent_runs", f"""SELECT id, job_name, message, status FROM (SELECT id, job_name, left(message, 200) AS message, status FROM (SELECT event_id AS id, event_type AS job_name, props AS message, user_id AS status, CASE WHEN event_id % 4 <> 0 THEN value END AS finished_at FROM events) ORDER BY finished_at DESC NULLS LAST, id DESC LIMIT 10)""")
def recent_runs(t: Tables):
    runs = t.events.select(
        c("event_id").alias("id"), c("event_type").alias("job_name"), c("props").alias("message"), c("user_id").alias("status"),
        F.when(c("event_id") % 4 != 0, c("value")).alias("finished_at"),
    )
    return audit.recent(runs).drop("finished_at")


# --- joins -------------------------------------------------------------------------------------


@query("inner_equi", "SELECT o_orderkey, o_custkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'")
def inner_equi(t: Tables):
    done = t.orders.filter("o_orderstatus = 'F'")
    return done.join(t.lineitem, c("o_orderkey") == c("l_orderkey")).select("o_orderkey", "o_custkey", "l_linenumber", "l_quantity")


@query("pending_meta", """SELECT c_custkey AS uuid FROM customer LEFT JOIN (SELECT user_id, bool_or(event_type IS DISTINCT FROM 'click') AS open FROM events WHERE value > 100 GROUP BY 1) ON c_custkey = user_id WHERE coalesce(open, true)""")
def pending_meta(t: Tables):
    ids = t.customer.select(c("c_custkey").alias("uuid"))
    meta = t.events.filter("value > 100").select(c("user_id").alias("uuid"), c("event_type").alias("status"))
    return links.pending(ids, meta, done="click")


@query("retry_pending", """SELECT c_custkey AS uuid FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type IN ('click', 'error') AND value > 120)""")
def retry_pending(t: Tables):
    outcome = F.when(c("event_type") == "click", F.lit("done")).when(c("event_type") == "error", F.lit("failed")).otherwise(F.lit("not_ready"))
    outcomes = t.events.filter("value > 120").select(c("user_id").alias("uuid"), outcome.alias("outcome"))
    return links.retry_pending(t.customer.select(c("c_custkey").alias("uuid")), outcomes)[0]


@query("anti_join", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def anti_join(t: Tables):
    return t.customer.join(t.orders.filter("o_orderstatus = 'P'"), c("c_custkey") == c("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("semi_join", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def semi_join(t: Tables):
    return t.customer.join(t.orders.filter("o_orderstatus = 'P'"), c("c_custkey") == c("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("parent_flag_refresh", f"SELECT o_orderkey AS id, o_orderkey IN (SELECT source_id FROM {LAYERS} WHERE task_key IS NOT NULL) AS tasked FROM orders")
def parent_flag_refresh(t: Tables):
    return guards.refresh_parent_flag(t.orders.select(c("o_orderkey").alias("id")), t.bind(b.LAYER_ROWS))


@query("frozen_guard", f"SELECT id, source_id FROM {LAYERS} WHERE source_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def frozen_guard(t: Tables):
    parents = t.orders.select(c("o_orderkey").alias("id"), (c("o_orderstatus") == "P").alias("tasked"))
    return guards.not_frozen(t.bind(b.LAYER_ROWS), parents).select("id", "source_id")


@query("orphan_items", f"""SELECT key FROM {ITEMS} WHERE NOT is_field_data AND is_office_task IS NOT TRUE AND (regexp_matches(coalesce(permit_id, ''), '^(point|line|polygon):') OR regexp_matches(coalesce(earthwork_id, ''), '^(point|line|polygon):'))
AND o_orderkey NOT IN (SELECT source_id FROM {LAYERS} WHERE task_key IS NOT NULL AND service = 'A')""")
def orphan_items(t: Tables):
    child = t.bind(b.LAYER_ROWS).filter("task_key IS NOT NULL AND service = 'A'").select(
        F.concat(F.lit("t"), F.lpad(c("source_id").cast("string"), 10, "0")).alias("task_key")
    )
    return links.orphans(t.bind(b.ITEMS), child, ["permit_id", "earthwork_id"]).select("key")


@query("text_key_join", f"SELECT i.key, c.c_name FROM {ITEMS} i JOIN customer c ON trim(i.label_id) = CAST(c.c_custkey AS VARCHAR)")
def text_key_join(t: Tables):
    items = t.bind(b.ITEMS).select("key", blank_to_null(c("label_id")).alias("k"))
    people = t.customer.select("c_name", c("c_custkey").cast("string").alias("k"))
    return items.join(people, "k").select("key", "c_name")


@query("fallback_match", """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'first' WHEN c_custkey IN (SELECT o_orderkey FROM orders) THEN 'second' ELSE 'missing' END AS match FROM customer""")
def fallback_match(t: Tables):
    return links.fallback_match(t.customer.select("c_custkey"), t.orders, "c_custkey", "o_custkey", "o_orderkey")


@query("latest_eligible", f"""SELECT p.cam_id, max('t' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0')) AS key FROM {PHOTOS} p JOIN {ITEMS} i ON p.id = i.o_orderkey WHERE field_observed IS NOT TRUE AND owner = 'etl' GROUP BY 1""")
def latest_eligible(t: Tables):
    items = t.bind(b.ITEMS).withColumn("user_last_edit", F.array("owner")).withColumn("photo_id", F.concat(F.lit("u"), c("o_orderkey")))
    return links.eligible_items(items, t.bind(b.PHOTOS), "photo_id")


_LINKITEMS = "SELECT concat('n', CAST(o_orderkey AS STRING)) AS key, concat('point:', CAST(o_orderkey AS STRING)) AS permit_id FROM {orders} UNION ALL SELECT concat('z', CAST(o_orderkey AS STRING)), concat('point:', CAST(o_orderkey AS STRING)) FROM {orders} WHERE o_orderkey % 2 = 0"
_LINKROWS = "SELECT event_id AS id, concat('point:', CAST(user_id * 3 AS STRING)) AS business_id, CASE WHEN event_type = 'click' THEN concat('n', CAST(user_id AS STRING)) END AS task_key, CASE WHEN event_type <> 'view' THEN 1 END AS geom FROM {events}"


@query("link_one_to_one", f"""
WITH r AS {sub(_LINKROWS)}, o AS (SELECT min(key) AS key, permit_id FROM {sub(_LINKITEMS)} WHERE key NOT IN (SELECT task_key FROM r WHERE task_key IS NOT NULL) GROUP BY permit_id),
ch AS (SELECT min(r.id) AS id, o.key FROM r JOIN o ON r.business_id = o.permit_id WHERE r.task_key IS NULL AND geom IS NOT NULL GROUP BY o.key)
SELECT r.id, coalesce(r.task_key, ch.key) AS task_key, CASE WHEN ch.key IS NOT NULL THEN 'update' ELSE 'keep' END AS action FROM r LEFT JOIN ch ON r.id = ch.id""")
def link_one_to_one(t: Tables):
    return links.link_once(t.bind(_LINKROWS), t.bind(_LINKITEMS), "business_id", "permit_id").select("id", "task_key", "action")


# --- counts ------------------------------------------------------------------------------------


@query("duplicate_keys", f"SELECT cam_id, status, count(*) AS n FROM {PHOTOS} GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(t: Tables):
    return audit.duplicates(t.bind(b.PHOTOS), ["cam_id", "status"])


@query("dup_geom_candidates", f"SELECT global_id, geom_hash, count(*) AS n FROM {LAYERS} GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY n DESC, global_id, geom_hash LIMIT 5")
def dup_geom_candidates(t: Tables):
    return audit.duplicate_geometries(t.bind(b.LAYER_ROWS), "global_id")


@query("count_distinct", "SELECT count(*) AS rows, count(DISTINCT o_custkey) AS customers FROM orders WHERE o_orderpriority NOT LIKE '1%'")
def count_distinct(t: Tables):
    return t.orders.filter(~c("o_orderpriority").startswith("1")).agg(
        F.count("*").alias("rows"), F.countDistinct("o_custkey").alias("customers")
    )


@query("missing_keys_list", f"SELECT (SELECT count(*) FROM {ITEMS} WHERE permit_id IS NULL) AS n, string_agg(key, ', ' ORDER BY key) AS keys FROM (SELECT key FROM {ITEMS} WHERE permit_id IS NULL ORDER BY key LIMIT 20)")
def missing_keys_list(t: Tables):
    return audit.first_keys(t.bind(b.ITEMS).filter("permit_id IS NULL"), "key")


_KNOWN = "SELECT service, business_id FROM {l} WHERE layer <> 'lines' OR service = 'A'".replace("{l}", LAYERS)
_AUDIT = f"""SELECT l.service, l.layer, count(*) AS total, count(*) FILTER (WHERE has_geom) AS with_geom, count(task_key) AS linked, count(*) FILTER (WHERE has_geom AND task_key IS NULL) AS gap,
count(task_key) + count(*) FILTER (WHERE has_geom AND task_key IS NULL AND k.business_id IS NOT NULL) AS item_match, count(*) FILTER (WHERE has_geom AND task_key IS NULL AND k.business_id IS NULL) AS would_insert,
coalesce(round(100e0 * count(task_key) / nullif(count(*) FILTER (WHERE has_geom), 0), 1), 0) AS linked_pct
FROM {LAYERS} l LEFT JOIN (SELECT DISTINCT service, business_id FROM ({_KNOWN})) k ON l.service = k.service AND l.business_id = k.business_id GROUP BY 1, 2"""


def _audited(t: Tables):
    layers = t.bind(b.LAYER_ROWS)
    return audit.link_audit(layers, layers.filter("layer <> 'lines' OR service = 'A'"))


@query("link_audit", _AUDIT)
def link_audit(t: Tables):
    return _audited(t)


_FALSE = f"""SELECT o_orderpriority AS service, o_orderkey AS id FROM orders WHERE o_orderstatus = 'P' AND NOT EXISTS (SELECT 1 FROM {LAYERS} l WHERE l.source_id = o_orderkey AND l.task_key IS NOT NULL)"""


def _flags(t: Tables):
    parents = t.orders.select(c("o_orderpriority").alias("service"), c("o_orderkey").alias("id"), (c("o_orderstatus") == "P").alias("tasked"))
    children = t.bind(b.LAYER_ROWS).drop("service").join(parents.select("service", c("id").alias("source_id")), "source_id")
    return audit.false_flags(parents, children)


@query("false_flags", f"SELECT s.service, count(f.id) AS n FROM (SELECT DISTINCT o_orderpriority AS service FROM orders) s LEFT JOIN ({_FALSE}) f ON s.service = f.service GROUP BY 1")
def false_flags(t: Tables):
    return _flags(t)


_ID_COLUMNS = ["permit_id", "earthwork_id", "label_id"]
_SCOPED = " UNION ALL ".join(
    f"SELECT '{x}' AS id_column, count(*) FILTER (WHERE {x} LIKE 'point:%') AS point, count(*) FILTER (WHERE {x} LIKE 'line:%') AS line, count(*) FILTER (WHERE {x} LIKE 'polygon:%') AS polygon, "
    f"count(*) FILTER (WHERE {x} LIKE 'point:%' OR {x} LIKE 'line:%' OR {x} LIKE 'polygon:%') AS total FROM {ITEMS}"
    for x in _ID_COLUMNS
)


@query("scoped_counts", _SCOPED)
def scoped_counts(t: Tables):
    return audit.scoped_counts(t.bind(b.ITEMS), _ID_COLUMNS)


@query("audit_summary", f"""
WITH l AS (SELECT CAST(sum(with_geom) AS BIGINT) AS with_geom, CAST(sum(gap) AS BIGINT) AS gap FROM ({_AUDIT})), f AS (SELECT count(*) AS false_flags FROM ({_FALSE})),
z AS (SELECT coalesce(string_agg(id_column, ',' ORDER BY id_column), '') AS zero_scoped FROM ({_SCOPED}) WHERE total = 0),
d AS (SELECT count(*) AS duplicate_keys FROM (SELECT task_key FROM {LAYERS} WHERE task_key IS NOT NULL GROUP BY 1 HAVING count(*) > 1)),
m AS (SELECT *, array_to_string(list_filter([CASE WHEN gap > 0 THEN 'gap=' || gap END, CASE WHEN zero_scoped <> '' THEN 'zero_scoped=' || zero_scoped END, CASE WHEN false_flags > 0 THEN 'false_tasked=' || false_flags END,
 CASE WHEN duplicate_keys > 0 THEN 'duplicate_task_key=' || duplicate_keys END], lambda x: x IS NOT NULL), '; ') AS m FROM l, f, z, d)
SELECT with_geom, gap, false_flags, zero_scoped, duplicate_keys, m <> '' AS alert, CASE WHEN m = '' THEN 'OK' ELSE m END AS message FROM m""")
def audit_summary(t: Tables):
    twice = audit.duplicates(t.bind(b.LAYER_ROWS), ["task_key"])
    return audit.summary(_audited(t), _flags(t), audit.scoped_counts(t.bind(b.ITEMS), _ID_COLUMNS), twice, _ID_COLUMNS)


@query("deletions_by_second", """SELECT strftime(date_trunc('minute', ts + INTERVAL 3 HOUR), '%Y-%m-%d %H:%M:%S') AS bucket, count(*) AS n, count(*) FILTER (WHERE event_type = 'click') AS clicks FROM events GROUP BY 1""")
def deletions_by_second(t: Tables):
    counts = audit.bucket_counts(t.events, "ts", "minute", "Europe/Moscow", {"clicks": c("event_type") == "click"})
    return counts.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm:ss"))


@query("table_fingerprint", """SELECT count(*) AS n, CAST(sum(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT) AS VARCHAR) AS keys_digest,
CAST(sum(('0x' || substr(md5(concat(o_orderkey, '|', o_custkey, '|', o_orderstatus, '|', o_orderpriority)), 1, 8))::BIGINT) AS VARCHAR) AS rows_digest FROM orders""")
def table_fingerprint(t: Tables):
    return audit.fingerprint(
        t.orders, c("o_orderkey").cast("string"), F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    )


@query("unique_names", "SELECT p_partkey, p_name, count(*) OVER (PARTITION BY p_name, p_size) = 1 AS name_unique FROM part")
def unique_names(t: Tables):
    named = t.part.select("p_partkey", "p_name", legacy_name(F.concat_ws(" ", "p_name", "p_size")).alias("legacy"))
    return links.unique_names(named, "legacy").select("p_partkey", "p_name", "name_unique")


@query("link_drop_check", f"SELECT count(task_key) AS linked_before, count(task_key) FILTER (WHERE service <> 'A') AS linked_after, count(task_key) FILTER (WHERE service <> 'A') < count(task_key) AS dropped FROM {LAYERS}")
def link_drop_check(t: Tables):
    layers = t.bind(b.LAYER_ROWS)
    return audit.check_links(layers, layers.filter("service <> 'A'"))


@query("load_counters", f"""SELECT service, CASE WHEN NOT has_geom THEN 'skipped' WHEN task_key IS NULL THEN 'loaded' ELSE 'linked' END AS action, count(*) AS n FROM {LAYERS} GROUP BY 1, 2""")
def load_counters(t: Tables):
    action = F.when(~c("has_geom"), "skipped").when(c("task_key").isNull(), "loaded").otherwise("linked")
    return t.bind(b.LAYER_ROWS).withColumn("action", action).groupBy("service", "action").agg(F.count("*").alias("n"))


# --- one row per key, numbers ------------------------------------------------------------------


@query("latest_per_key", f"SELECT cam_id, max(id) AS id, arg_max(uuid, id) AS uuid, arg_max(status, id) AS status FROM {PHOTOS} WHERE disruption GROUP BY cam_id")
def latest_per_key(t: Tables):
    return links.latest_photos(t.bind(b.PHOTOS).filter("disruption"), c("cam_id")).select("cam_id", "id", "uuid", "status")


@query("last_wins", """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1""")
def last_wins(t: Tables):
    order = [c(x) for x in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")]
    return keep.last_wins(t.lineitem, ["l_orderkey"], order).select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")


@query("best_priority", f"""SELECT source_id, layer, id FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY CASE layer WHEN 'polygons' THEN 2 WHEN 'lines' THEN 1 ELSE 0 END DESC, id, global_id, business_id, service, geom_hash, task_key, has_geom) AS rn FROM {LAYERS}) WHERE rn = 1""")
def best_priority(t: Tables):
    prio = F.when(c("layer") == "polygons", 2).when(c("layer") == "lines", 1).otherwise(0)
    return keep.first_per(t.bind(b.LAYER_ROWS), [c("source_id")], [-prio, c("id")]).select("source_id", "layer", "id")


_NUMBERED = "SELECT p_partkey AS key, concat(p_type, '-', CAST(p_size AS STRING)) AS task_number, p_type AS prefix, p_size AS n, p_retailprice AS north, CASE p_brand WHEN 'Brand#1' THEN 'done' WHEN 'Brand#2' THEN 'wip' ELSE 'free' END AS status FROM {part}"
_RANKED = f"""SELECT *, row_number() OVER (PARTITION BY task_number ORDER BY CASE status WHEN 'done' THEN 0 WHEN 'wip' THEN 1 ELSE 2 END, north DESC, key) AS keep_rn, count(*) OVER (PARTITION BY task_number) AS cnt FROM {sub(_NUMBERED)}"""


def _ranked(t: Tables):
    rows = t.bind(_NUMBERED)
    doubled = audit.duplicates(rows, ["task_number"]).select("task_number")
    state = F.when(c("status") == "done", 0).when(c("status") == "wip", 1).otherwise(2)
    return numbering.number_rows(
        rows.join(doubled, "task_number"), ["task_number"], [state.asc(), c("north").desc_nulls_last(), c("key").asc()], "keep_rn"
    )


@query("dup_keeper_rank", f"SELECT key, task_number, keep_rn FROM ({_RANKED}) WHERE cnt > 1")
def dup_keeper_rank(t: Tables):
    return _ranked(t).select("key", "task_number", "keep_rn")


@query("free_number_alloc", f"""
WITH r AS ({_RANKED}), f AS (SELECT key, prefix, row_number() OVER (PARTITION BY prefix ORDER BY keep_rn, key) AS seq FROM r WHERE cnt > 1 AND keep_rn > 1),
k AS (SELECT DISTINCT prefix, n FROM r WHERE NOT (cnt > 1 AND keep_rn > 1)), p AS (SELECT prefix, count(*) AS m FROM f GROUP BY 1),
a AS (SELECT prefix, n, row_number() OVER (PARTITION BY prefix ORDER BY n) AS ord FROM (SELECT prefix, unnest(range(1, m + 1 + coalesce((SELECT max(n) FROM k WHERE k.prefix = p.prefix), 0))) AS n FROM p) g
 WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.prefix = g.prefix AND k.n = g.n))
SELECT f.key, f.prefix || '-' || a.n AS new_number FROM f JOIN a ON f.prefix = a.prefix AND f.seq = a.ord""")
def free_number_alloc(t: Tables):
    ranked = _ranked(t)
    losers = numbering.number_rows(
        ranked.filter("keep_rn > 1").select("key", "prefix", "keep_rn"), ["prefix"], [c("keep_rn").asc(), c("key").asc()], "seq"
    )
    kept = t.bind(_NUMBERED).join(losers.select("key"), "key", "left_anti").select("prefix", "n")
    made = numbering.allocate_free(losers, kept)
    return made.select("key", F.concat_ws("-", "prefix", "new_n").alias("new_number"))


_SAVED = "SELECT concat('k', CAST(event_id AS STRING)) AS task_key, CASE WHEN event_type <> 'view' THEN user_id END AS global_id, CASE WHEN event_type = 'click' THEN 'h1' ELSE 'h2' END AS geom_hash, event_id AS old_id FROM {events}"
_ROWS = "SELECT o_orderkey AS id, o_custkey AS global_id, CASE WHEN o_orderstatus = 'F' THEN 'h1' ELSE 'h2' END AS geom_hash, CASE WHEN o_orderpriority = '1-URGENT' THEN concat('k', CAST(o_orderkey AS STRING)) END AS task_key FROM {orders}"


@query("restore_links", f"""
WITH r AS {sub(_ROWS)}, s AS (SELECT * FROM {sub(_SAVED)} WHERE task_key NOT IN (SELECT task_key FROM r WHERE task_key IS NOT NULL)),
k AS (SELECT *, row_number() OVER (PARTITION BY global_id, geom_hash ORDER BY old_id) AS rn FROM s WHERE global_id IS NOT NULL),
f AS (SELECT *, row_number() OVER (PARTITION BY global_id, geom_hash ORDER BY id) AS rn FROM r WHERE task_key IS NULL),
p AS (SELECT f.id, k.task_key FROM k JOIN f ON k.global_id = f.global_id AND k.geom_hash = f.geom_hash AND k.rn = f.rn),
e AS (SELECT id, task_key FROM p UNION ALL SELECT old_id, task_key FROM s WHERE global_id IS NULL AND old_id NOT IN (SELECT id FROM p))
SELECT r.id, coalesce(r.task_key, e.task_key) AS task_key, CASE WHEN r.task_key IS NULL AND e.task_key IS NOT NULL THEN 'update' ELSE 'keep' END AS action FROM r LEFT JOIN e ON r.id = e.id""")
def restore_links(t: Tables):
    return links.restore_links(t.bind(_ROWS), t.bind(_SAVED)).select("id", "task_key", "action")


# --- order, sets -------------------------------------------------------------------------------


@query("bootstrap_topk", "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 50")
def bootstrap_topk(t: Tables):
    return tables.read_incremental(t.events, "event_id", 0).select("event_id", "event_type")


@query("ordered_worklist", "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS place, o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def ordered_worklist(t: Tables):
    work = t.orders.filter("o_orderstatus = 'P'").select("o_orderkey", "o_orderdate")
    return numbering.number_rows(work, [], [c("o_orderdate").asc(), c("o_orderkey").asc()], "place").select("place", "o_orderkey")


@query("capped_worklist", "SELECT o_orderkey FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100) UNION ALL SELECT c_custkey FROM customer")
def capped_worklist(t: Tables):
    head = keep.top_by(t.orders, [c("o_totalprice").desc(), c("o_orderkey").asc()], 100).select("o_orderkey")
    return head.unionByName(keep.top_by(t.customer, [c("c_custkey").asc()], 0).select(c("c_custkey").alias("o_orderkey")))


@query("union_all_layers", f"SELECT layer, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM {LAYERS} GROUP BY 1")
def union_all_layers(t: Tables):
    rows = t.bind(b.LAYER_ROWS).select("id", "layer")
    parts = [rows.filter(c("layer") == name) for name in ("points", "lines", "polygons")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("layer").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


_IDS = "SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer UNION SELECT CAST(user_id AS VARCHAR) FROM events UNION SELECT nullif(trim(o_orderpriority), '') FROM orders"


@query("known_ids", f"SELECT id FROM ({_IDS}) WHERE id IS NOT NULL")
def known_ids(t: Tables):
    return links.union_ids(t.customer.select("c_custkey"), t.events.select("user_id"), t.orders.select("o_orderpriority"))


@query("new_ids", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events) AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def new_ids(t: Tables):
    return links.new_ids(t.orders.select("o_custkey"), t.events.select("user_id"), t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey"))


@query("distinct_names", "SELECT DISTINCT p_name, p_brand FROM part WHERE trim(p_name) <> ''")
def distinct_names(t: Tables):
    return t.part.filter(F.trim("p_name") != "").select("p_name", "p_brand").distinct()


@query("snapshot_copy", f"SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_returnflag = 'A' THEN 'own' END, o_orderpriority) AS area_key FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey")
def snapshot_copy(t: Tables):
    child = t.lineitem.select("l_orderkey", "l_linenumber", F.when(c("l_returnflag") == "A", F.lit("own")).alias("area_key"))
    parent = t.orders.select(c("o_orderkey").alias("l_orderkey"), c("o_orderpriority").alias("area_key"))
    filled = merge.update_from(child, parent, ["l_orderkey"], ["area_key"], c("t.area_key").isNull())
    return filled.drop("action")

