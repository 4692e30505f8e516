"""Queries that run whole jobs, sources and streams over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosync.contract import bindings as b
from geosync.contract.geoms import _BESSEL as BESSEL
from geosync.contract.geoms import _COVERED as COVERED
from geosync.contract.geoms import CELL, DISTRICTS, SQUARES, _districts, _points, _squares
from geosync.contract.registry import Tables, query, sub
from geosync.contract.values import _PARSED, AS_OF
from geosync.functions import geom as g
from geosync.functions.reproject import LOCAL_SRID
from geosync.operators.numbering import number_rows
from geosync.plans import areas, features, items, mirrors, photos
from geosync.session import cut_lineage, shared_folder
from geosync.sources import buckets
from geosync.sources.paged import PAGE_SIZE, paged_features as read_pages
from geosync.streaming import inbox

c = F.col
PERMITS = items.Service("permits", "Permits", "permit_id")


def _day():
    return F.to_date(F.lit(AS_OF))


def _scratch(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _paged(rows: DataFrame, key: str, feature) -> DataFrame:
    """Features in pages of the service's size: ``page`` and its text."""
    numbered = number_rows(rows.withColumn("feature", feature), [], [c(key).asc()], "n")
    paged = numbered.withColumn("page", F.floor((c("n") - 1) / PAGE_SIZE).cast("long"))
    # A page is as long as the service makes it.
    listed = F.transform(F.array_sort(F.collect_list(F.struct("n", "feature"))), lambda f: f["feature"])
    body = F.concat(F.lit('{"features":['), F.array_join(listed, ","), F.lit("]}"))
    return paged.groupBy("page").agg(body.alias("value"))


# --- sources and streams -----------------------------------------------------------------------


@query("paged_features", "SELECT CAST(floor((rn - 1) / 500) AS BIGINT) AS page, CAST((rn - 1) % 500 AS INTEGER) AS idx, CAST(p_partkey AS VARCHAR) AS k FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS rn FROM part)")
def paged_features(t: Tables):
    feature = F.concat(F.lit('{"type":"Feature","k":'), c("p_partkey"), F.lit("}"))
    folder = _scratch(t, "pages")
    _paged(t.part, "p_partkey", feature).write.partitionBy("page").text(folder)
    read = read_pages(t.spark, folder, stripes=4)
    return read.select("page", "idx", F.get_json_object("feature", "$.k").alias("k"))


@query("paged_stream", "SELECT event_id AS id, event_type AS kind, CASE WHEN event_type = 'view' THEN NULL ELSE CAST(user_id AS BIGINT) END AS size FROM events")
def paged_stream(t: Tables):
    size = F.when(c("event_type") == "view", F.lit("null")).otherwise(c("user_id").cast("string"))
    feature = F.concat(
        F.lit('{"type":"Feature","geometry":null,"properties":{"rowNo":'), c("event_id"), F.lit(',"attributes":{"Kind":"'),
        c("event_type"), F.lit('","Size":'), size, F.lit("}}}"),
    )
    folder, out = _scratch(t, "stream-pages"), _scratch(t, "stream-out")
    pages = cut_lineage(_paged(t.events, "event_id", feature))
    middle = (pages.agg(F.max("page")).first()[0] or 0) // 2
    # Some pages, a stop, and the others after a start from the checkpoint.
    for some in (c("page") <= middle, c("page") > middle):
        pages.filter(some).write.mode("append").partitionBy("page").text(folder)
        inbox.paged_stream(t.spark, folder, f"{out}/rows", f"{out}/types", f"{out}/checkpoint", once=True).awaitTermination()
    rows = t.spark.read.parquet(f"{out}/rows")
    return rows.select(c("row_no").alias("id"), "kind", "size")


_INBOX = "SELECT CAST(o_orderkey AS STRING) AS order_no, CASE o_orderkey % 4 WHEN 3 THEN 'soon' ELSE " + b.dotted("o_orderdate") + " END AS date, CASE WHEN o_custkey % 9 = 0 THEN ' ' ELSE concat('ex', CAST(o_custkey AS STRING)) END AS executor FROM {orders}"


@query("inbox_stream", f"""WITH a AS (SELECT o_orderkey AS k, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d, 'ex' || o_custkey AS e FROM orders WHERE o_orderkey % 4 <> 3 AND o_custkey % 9 <> 0),
t AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS n1, c_custkey + 1 AS n2 FROM customer)
SELECT c_custkey, coalesce(f.d, s.d) AS assigned_on, coalesce(f.e, s.e) AS executor FROM t LEFT JOIN a f ON f.k = n1 LEFT JOIN a s ON s.k = n2 AND s.k NOT IN (SELECT n1 FROM t WHERE n1 IS NOT NULL)""")
def inbox_stream(t: Tables):
    root = _scratch(t, "inbox")
    target = t.customer.select(
        "c_custkey", F.when(c("c_custkey") % 2 == 0, c("c_custkey").cast("string")).alias("order_name"),
        (c("c_custkey") + 1).cast("string").alias("order"), F.lit(None).cast("date").alias("assigned_on"),
        F.lit(None).cast("string").alias("executor"),
    )
    buckets.create(target, f"{root}/target", ["c_custkey"], buckets=8)
    rows = t.bind(_INBOX)
    # Two arrivals, with a start from the checkpoint between them; both numbers of a row come in one.
    half = F.floor(c("order_no").cast("long") / 2) % 2
    for k in (0, 1):
        rows.filter(half == k).write.mode("append").option("header", "true").csv(f"{root}/files")
        inbox.inbox_stream(t.spark, f"{root}/files", f"{root}/target", f"{root}/log", f"{root}/checkpoint", once=True).awaitTermination()
    return buckets.read(t.spark, f"{root}/target").select("c_custkey", c("assigned_on").cast("string").alias("assigned_on"), "executor")


# --- jobs --------------------------------------------------------------------------------------

_FEATURES = "SELECT id, text_date, o_orderstatus FROM (" + b.DATED + ")"


@query("job_reload", f"""SELECT CASE WHEN coalesce({_PARSED} <= DATE '{AS_OF}' - INTERVAL 1 MONTH, false) THEN 'delete' ELSE 'keep' END AS action, count(*) AS n FROM {sub(_FEATURES)} GROUP BY 1""")
def job_reload(t: Tables):
    properties = F.to_json(F.struct(c("text_date").alias("WorkEndDate"), c("o_orderstatus").alias("status")))
    loaded = t.spread(_FEATURES).select(
        properties.alias("properties"), g.point(F.lit(37.5), F.lit(55.5)).alias("geom"), c("id").alias("ord")
    )
    return features.load_reload(loaded, features.PurgeRule("work_end_date", "date"), _day())[1]


def _no_items(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([], items.ITEM_SCHEMA)


def _layer_rows(t: Tables) -> DataFrame:
    rows = t.bind("SELECT o_orderkey AS id, o_orderkey AS source_id, o_custkey AS global_id, o_orderstatus, o_orderpriority FROM {orders}")
    layer = F.when(c("o_orderstatus") == "F", "points").when(c("o_orderstatus") == "O", "lines").otherwise("polygons")
    return rows.select(
        "id", "source_id", "global_id", layer.alias("layer"), F.md5("o_orderpriority").alias("geom_hash"),
        F.when(c("o_orderpriority") != "5-LOW", g.point(c("id"), c("id"))).alias("geom"), F.lit(None).cast("string").alias("task_key"),
    )


def uuid_sql(text: str) -> str:
    """The key of an item by its business id, as the oracle writes it."""
    return f"concat_ws('-', substr(md5({text}), 1, 8), substr(md5({text}), 9, 4), substr(md5({text}), 13, 4), substr(md5({text}), 17, 4), substr(md5({text}), 21, 12))"


@query("job_sync_layer_items", f"""WITH r AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'points' WHEN 'O' THEN 'lines' ELSE 'polygons' END AS layer, o_orderpriority <> '5-LOW' AS open FROM orders),
k AS (SELECT *, replace(layer, 's', '') || ':' || o_orderkey AS b FROM r)
SELECT o_orderkey AS id, layer, CASE WHEN open THEN {uuid_sql("'permit_id|' || b")} END AS task_key, CASE WHEN open THEN b END AS permit_id, CASE WHEN open THEN 'permits' END AS source_table,
CASE WHEN open THEN o_orderkey END AS source_row_id, CASE WHEN open THEN o_custkey END AS source_global_id, CASE WHEN open THEN md5(o_orderpriority) END AS source_geom_hash, open AS tasked FROM k""")
def job_sync_layer_items(t: Tables):
    rows = _layer_rows(t)
    parents = rows.select(c("source_id").alias("id"), F.lit(False).alias("tasked"))
    done = items.sync_layer_items(rows, _no_items(t), parents, PERMITS, _day())
    made = done["items"].select(c("key").alias("task_key"), "permit_id", "source_table", "source_row_id", "source_global_id", "source_geom_hash")
    # An item without a row, or made twice, would show as a row of its own.
    linked = done["layers"].select("id", "source_id", "layer", "task_key").join(made, "task_key", "full")
    flags = done["parents"].select(c("id").alias("source_id"), "tasked")
    return linked.join(flags, "source_id", "left").drop("source_id")


_ELIGIBLE = f"SELECT p.cam_id, max(i.key) AS key FROM {sub(b.PHOTOS)} p JOIN {sub(b.ITEMS)} i ON p.id = i.o_orderkey WHERE i.field_observed IS NOT TRUE AND i.owner = 'etl' GROUP BY 1"


@query("job_sync_photo_items", f"""
WITH e AS ({_ELIGIBLE}), p AS (SELECT * FROM {sub(b.PHOTOS)} WHERE disruption), n AS (SELECT cam_id, max(id) AS id FROM p GROUP BY 1),
r AS (SELECT e.key, n.id FROM e JOIN n ON e.cam_id = n.cam_id JOIN {sub(b.ITEMS)} i ON i.key = e.key WHERE i.o_orderkey <> n.id),
k AS (SELECT i.key, coalesce(r.id, i.o_orderkey) AS photo, i.field_observed, CASE WHEN r.id IS NOT NULL THEN 'etl' ELSE i.owner END AS owner FROM {sub(b.ITEMS)} i LEFT JOIN r ON i.key = r.key),
busy AS (SELECT DISTINCT a.cam_id FROM {sub(b.PHOTOS)} a JOIN k ON a.id = k.photo WHERE field_observed IS NOT TRUE AND owner = 'etl'),
w AS (SELECT cam_id, max(id) AS id FROM p WHERE id NOT IN (SELECT photo FROM k) AND cam_id NOT IN (SELECT cam_id FROM busy) GROUP BY 1)
SELECT k.key, 'u' || k.photo AS photo_id, a.id AS source_row_id, k.owner FROM k LEFT JOIN {sub(b.PHOTOS)} a ON a.id = k.photo
UNION ALL SELECT {uuid_sql("'photo_id|u' || id")}, 'u' || id, id, 'etl' FROM w""")
def job_sync_photo_items(t: Tables):
    seen = t.bind(b.PHOTOS).withColumn("geom", g.point(c("id"), c("cam_id")))
    have = t.bind(b.ITEMS).select(
        "key", F.concat(F.lit("u"), c("o_orderkey")).alias("photo_id"), "field_observed", F.array("owner").alias("user_last_edit")
    )
    current = _no_items(t).unionByName(have, allowMissingColumns=True)
    done = items.sync_photo_items(seen, current, "Photos", "photos", _day())["items"]
    return done.select("key", "photo_id", "source_row_id", c("user_last_edit")[0].alias("owner"))


@query("job_mirror", f"""WITH src AS (SELECT c_custkey AS id, CAST(c_custkey % 997 * 60 - 30000 AS DOUBLE) AS x, CAST(c_custkey % 991 * 50 - 25000 AS DOUBLE) AS y FROM customer), {BESSEL}
SELECT id, c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'seen' END AS executor, 'multipoint' AS kind, round(degrees(atan2(wy, wx)), 8) AS lon,
round(degrees(atan2(wz + f2/(1-f2)*wb*pow(sin(th),3), p - f2*wa*pow(cos(th),3))), 8) AS lat FROM u JOIN customer ON id = c_custkey""")
def job_mirror(t: Tables):
    place = g.point((c("c_custkey") % 997 * 60 - 30000).cast("double"), (c("c_custkey") % 991 * 50 - 25000).cast("double"), LOCAL_SRID)
    source = t.customer.select(c("c_custkey").alias("id"), "c_name", place.alias("geom"), "c_mktsegment")
    empty = source.select("id", "c_name", "geom").limit(0).withColumn("executor", F.lit(None).cast("string"))
    first = mirrors.mirror_job(source, empty, "id", ["c_name", "geom"])["table"]
    old = first.join(source.select("id", "c_mktsegment"), "id").filter("c_mktsegment <> 'BUILDING'")
    target = old.withColumn("c_name", F.when(c("c_mktsegment") == "MACHINERY", F.lit("old")).otherwise(c("c_name"))).drop("c_mktsegment")
    # A row that the source no longer has goes; what only the target knows stays.
    gone = target.withColumn("id", -1 - c("id"))
    known = target.withColumn("executor", F.lit("seen")).unionByName(gone)
    done = mirrors.mirror_job(source, known, "id", ["c_name", "geom"])["table"]
    at = g.start_point(c("geom"))
    return done.select("id", "c_name", "executor", c("geom.kind").alias("kind"), F.round(at["x"], 8).alias("lon"), F.round(at["y"], 8).alias("lat"))


@query("job_label_ingest", """SELECT c_name AS label_text, CAST(c_nationkey AS VARCHAR) AS source_json, max(c_custkey) AS source_fid FROM customer WHERE contains(lower(c_mktsegment), 'build') OR contains(lower(c_mktsegment), 'house') GROUP BY c_name, c_nationkey, c_custkey""")
def job_label_ingest(t: Tables):
    source = t.customer.select(
        c("c_custkey").alias("fid"), c("c_name").alias("label"), c("c_nationkey").alias("number"), "c_mktsegment",
        g.point((c("c_custkey") * 3).cast("double"), (c("c_custkey") % 991).cast("double"), LOCAL_SRID).alias("geom"),
    )
    target = t.spark.createDataFrame(
        [], f"label_text string, filter_pass string, source_json string, lon double, lat double, geometry {g.GEOMETRY}, source_fid bigint, loaded_at timestamp"
    )
    wanted = mirrors.match_any(c("c_mktsegment"), ("BUILD", "house"))
    every = 2**31 - 1
    done = mirrors.ingest_labels(source, target, "words", wanted, _day(), bootstrap=every)
    return done["table"].select("label_text", "source_json", "source_fid")


@query("job_replace_by_key", """SELECT CAST(c_nationkey AS BIGINT) AS boundary_id, max(c_custkey) AS last FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1 HAVING max(c_custkey) IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def job_replace_by_key(t: Tables):
    state = F.when(c("c_mktsegment") == "BUILDING", F.lit("Истек вчера")).otherwise(F.lit("Действует"))
    key = F.when(c("c_mktsegment") != "MACHINERY", c("c_nationkey"))
    properties = F.to_json(F.struct(key.alias("boundaryId"), state.alias("status"), c("c_custkey").alias("last")))
    loaded = t.customer.select(properties.alias("properties"), g.point(F.lit(1.0), F.lit(1.0)).alias("geom"), c("c_custkey").alias("ord"))
    return mirrors.replace_by_key(loaded, "boundary_id")["table"].select("boundary_id", "last")


@query("job_refresh_area_keys", f"""SELECT p.id AS key, string_agg(CAST(s.key AS VARCHAR), ',' ORDER BY s.key) AS keys, CASE WHEN count(s.key) = 0 THEN 'keep' ELSE 'update' END AS action FROM {sub(b.POINTS)} p LEFT JOIN {SQUARES} s
ON p.lon >= s.x0 AND p.lon <= s.x1 AND p.lat >= s.y0 AND p.lat <= s.y1 GROUP BY p.id""")
def job_refresh_area_keys(t: Tables):
    points = _points(t).select(c("id").alias("task_key"), "geom")
    todo = t.customer.select(c("c_custkey").alias("key"), F.lit(None).cast("array<bigint>").alias("area_key"))
    done = areas.refresh_area_keys(todo, points, _squares(t).select("key", "geom"), cell=0.01)
    return done.select("key", F.array_join(F.transform("area_key", lambda k: k.cast("string")), ",").alias("keys"), "action")


_DOUBLE = "SELECT s_suppkey AS key, concat('M-', CAST(s_nationkey % 3 AS STRING), '/x-', CAST(s_suppkey % 20 + 1 AS STRING)) AS task_number, CASE s_suppkey % 3 WHEN 0 THEN 'done' WHEN 1 THEN 'wip' ELSE 'free' END AS status FROM {supplier}"


@query("job_repair_numbers", f"""WITH z AS (SELECT a.*, regexp_extract(task_number, '^(.*)-[0-9]+$', 1) AS prefix, CAST(regexp_extract(task_number, '([0-9]+)$', 1) AS BIGINT) AS n, d.gid, round((s.y0 + s.y1) / 2, 9) AS north
 FROM {sub(_DOUBLE)} a JOIN {SQUARES} s ON a.key = s.key LEFT JOIN {DISTRICTS} d ON {COVERED}),
r AS (SELECT *, row_number() OVER (PARTITION BY task_number ORDER BY CASE status WHEN 'done' THEN 0 WHEN 'wip' THEN 1 ELSE 2 END, gid IS NULL, north DESC, key) AS rn FROM z),
l AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY rn, key) AS seq FROM r WHERE rn > 1),
x AS (SELECT prefix, unnest(range(1, 21 + count(*))) AS n FROM r GROUP BY 1),
f AS (SELECT x.*, row_number() OVER (PARTITION BY x.prefix ORDER BY x.n) AS seq FROM x LEFT JOIN r ON rn = 1 AND r.prefix = x.prefix AND r.n = x.n WHERE r.n IS NULL)
SELECT r.key, coalesce(r.prefix || '-' || f.n, r.task_number) AS task_number, CASE WHEN r.rn > 1 THEN 'update' ELSE 'keep' END AS action FROM r LEFT JOIN l ON l.key = r.key LEFT JOIN f ON f.prefix = l.prefix AND f.seq = l.seq""")
def job_repair_numbers(t: Tables):
    numbered = t.bind(_DOUBLE).join(_squares(t).select("key", "geom"), "key")
    return areas.repair_numbers(numbered, _districts(t), cell=CELL).select("key", "task_number", "action")


@query("job_reactivate", f"""WITH d AS (SELECT * FROM {sub(b.DISTRICTS)} WHERE rayon = 'NATION_12'),
k AS (SELECT p.id FROM {sub(b.POINTS)} p, d WHERE p.lon >= d.x0 AND p.lon <= d.x1 AND p.lat >= d.y0 AND p.lat <= d.y1 UNION SELECT c_custkey FROM customer WHERE c_nationkey = 12)
SELECT o_orderstatus AS status, count(*) AS before, count(k.id) AS deleted, count(*) - count(k.id) AS "left", (SELECT count(*) FROM k) AS items FROM orders LEFT JOIN k ON o_custkey = k.id GROUP BY 1""")
def job_reactivate(t: Tables):
    people = t.customer.select("c_custkey", F.concat(F.lit("nation_"), c("c_nationkey")).alias("rayon"))
    snapshots = t.orders.select(c("o_orderstatus").alias("status"), c("o_custkey").alias("task_key")).join(
        people.withColumnRenamed("c_custkey", "task_key"), "task_key", "left"
    )
    # A customer of the nation without any order has no snapshot to be found by.
    extra = people.select(F.lit("none").alias("status"), c("c_custkey").alias("task_key"), "rayon").join(
        t.orders.select(c("o_custkey").alias("task_key")), "task_key", "left_anti"
    )
    points = _points(t).select(c("id").alias("task_key"), "geom")
    done = areas.reactivate("NATION_12", t.customer.select(c("c_custkey").alias("key")), points, _districts(t), snapshots.unionByName(extra), cell=CELL)
    return done[1].filter("status <> 'none'")


@query("job_photo_worklist", """SELECT o_orderkey AS oid, CASE WHEN o_totalprice < 150000 THEN 'bad_path' WHEN o_totalprice < 300000 THEN 'missing' ELSE 'photo' END AS outcome FROM orders WHERE (o_orderstatus <> 'F') AND o_orderpriority = '1-URGENT'""")
def job_photo_worklist(t: Tables):
    from datetime import date

    work = t.orders.select(
        c("o_orderkey").alias("oid"), F.when(c("o_orderstatus") != "P", F.concat("o_orderstatus", "o_orderkey")).alias("ono"),
        c("o_orderstatus").alias("ogno"), c("o_orderpriority").alias("opernm"), c("o_orderdate").cast("date").alias("edf"), "o_totalprice",
    )
    name = F.when(c("o_totalprice") < 150000, F.concat(F.lit("/abs/"), c("oid"))).otherwise(
        F.concat(F.lit("dir\\"), c("oid"), F.lit("\\p.jpg"))
    )
    files = work.select("oid", name.alias("fnm"))
    listing = work.filter("o_totalprice >= 300000").select(F.concat(F.lit("dir/"), c("oid"), F.lit("/p.jpg")).alias("relpath"))
    todo = photos.file_worklist(work, files, "F", "1-URGENT", date(1990, 1, 1))
    return photos.match_files(todo, listing).select("oid", "outcome")


@query("job_download_worklist", """SELECT 'u' || p_partkey AS uuid, CASE WHEN p_size > 40 THEN 'stored' WHEN count(*) OVER (PARTITION BY p_name, p_size) = 1 AND p_size < 20 THEN 'reuse' ELSE 'fetch' END AS action FROM part""")
def job_download_worklist(t: Tables):
    name = F.concat_ws(" ", "p_name", "p_size")
    meta = t.part.select(F.concat(F.lit("u"), c("p_partkey")).alias("uuid"), F.concat(name, F.lit(".jpg")).alias("image_name"))
    stored = t.part.filter("p_size > 40").select(F.concat(F.lit("u"), c("p_partkey"), F.lit(".png")).alias("name")).unionByName(
        t.part.filter("p_size < 20").select(F.concat(name, F.lit(".jpg")).alias("name"))
    )
    return photos.download_worklist(meta, stored).select("uuid", "action")
