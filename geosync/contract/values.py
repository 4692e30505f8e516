"""Queries over values: text, dates, JSON, schema, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from geosync.contract import bindings as b
from geosync.contract.registry import Tables, query, sub
from geosync.functions import dates, jsonx, text
from geosync.operators import audit, purge, schema
from geosync.operators.merge import count_actions
from geosync.sources import docs

c = F.col

# --- names and text ----------------------------------------------------------------------------

KEYS = (
    "SELECT p_partkey AS id, CASE p_partkey % 7 WHEN 0 THEN concat(p_type, 'OrderNumber', CAST(p_size AS STRING)) "
    "WHEN 1 THEN concat('  ', p_name, ' ') WHEN 2 THEN concat(CAST(p_size AS STRING), 'thFloor') WHEN 3 THEN 'Дата' "
    "WHEN 4 THEN CASE WHEN p_size > 25 THEN 'Geom' ELSE 'loadedAt' END WHEN 5 THEN concat(p_brand, repeat('LongName', 9)) "
    "ELSE concat('work', p_brand, '__End-Date') END AS key FROM {part}"
)


@query("column_name_norm", f"""
WITH k AS (SELECT id, key FROM {sub(KEYS)}),
s AS (SELECT id, key, regexp_replace(regexp_replace(trim(key), '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g') AS v FROM k),
n AS (SELECT id, key, lower(trim(regexp_replace(v, '[^a-zA-Z0-9]+', '_', 'g'), '_')) AS v FROM s),
f AS (SELECT id, key, left(CASE WHEN regexp_matches(v, '^[0-9]') THEN 'field_' || v ELSE v END, 63) AS v FROM n)
SELECT id, key, CASE WHEN v NOT IN ('id','geom','loaded_at','task_key') AND regexp_matches(v, '^[a-z][a-z0-9_]*$') THEN v END AS column_name FROM f""")
def column_name_norm(t: Tables):
    return t.bind(KEYS).select("id", "key", text.to_column_name(c("key")).alias("column_name"))


NAMES = (
    "SELECT c_custkey AS id, CASE c_custkey % 6 WHEN 0 THEN c_mktsegment WHEN 1 THEN concat('  ', c_mktsegment, ' ') "
    "WHEN 2 THEN concat('Old', chr(13), chr(10), c_mktsegment, '   - ', 'North') WHEN 3 THEN '   ' WHEN 4 THEN NULL "
    "ELSE concat('_', c_name, ' -- x ') END AS v, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' "
    "ELSE concat(' ', c_name) END AS w FROM {customer}"
)


@query("blank_to_null", f"SELECT id, nullif(trim(v), '') AS cleaned FROM {sub(NAMES)}")
def blank_to_null(t: Tables):
    return t.bind(NAMES).select("id", text.blank_to_null(c("v")).alias("cleaned"))


@query("effective_id", f"SELECT id, coalesce(nullif(trim(v), ''), nullif(trim(w), '')) AS eid FROM {sub(NAMES)}")
def effective_id(t: Tables):
    return t.bind(NAMES).select("id", text.effective_id(c("v"), c("w")).alias("eid"))


_ATTR = "nullif(trim(regexp_replace(regexp_replace(regexp_replace(v, '[\\r\\n]+', ' ', 'g'), '\\s+', ' ', 'g'), '\\s*-\\s*', '-', 'g')), '')"


@query("normalize_attr", f"SELECT id, {_ATTR} AS attr FROM {sub(NAMES)}")
def normalize_attr(t: Tables):
    return t.bind(NAMES).select("id", text.normalize_attr(c("v")).alias("attr"))


@query("normalize_label", f"SELECT id, trim(regexp_replace(regexp_replace({_ATTR}, '[ -]+', '_', 'g'), '_+', '_', 'g'), '_') AS label FROM {sub(NAMES)}")
def normalize_label(t: Tables):
    return t.bind(NAMES).select("id", text.normalize_label(c("v")).alias("label"))


NUMBERS = (
    "SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN concat('M/', p_brand, '-24-1/', p_name, '-', CAST(p_size AS STRING)) "
    "WHEN 1 THEN concat(p_brand, '-x') ELSE p_name END AS v FROM {part}"
)


@query("split_numbered_id", f"""SELECT id, regexp_replace(v, '-[0-9]+$', '') AS prefix,
TRY_CAST(nullif(regexp_extract(v, '-([0-9]+)$', 1), '') AS INTEGER) AS n FROM {sub(NUMBERS)}""")
def split_numbered_id(t: Tables):
    return t.bind(NUMBERS).select("id", text.split_number(c("v")).alias("s")).select("id", "s.prefix", "s.n")


FILES = (
    "SELECT p_partkey AS id, CASE p_partkey % 8 WHEN 0 THEN concat('dir/', p_name, '.JPG') WHEN 1 THEN concat(p_name, '.gif') "
    "WHEN 2 THEN concat('..', p_brand, '..png') WHEN 3 THEN '' WHEN 4 THEN concat(p_name, '?*:', p_brand, '.jpeg') "
    "WHEN 5 THEN concat(repeat(concat(p_name, '_'), 25), '.png') WHEN 6 THEN '***' "
    "ELSE concat('a/2024-05-', lpad(CAST(p_size % 28 + 1 AS STRING), 2, '0'), ' ', p_name, '.png/') END AS v, "
    "CASE p_partkey % 4 WHEN 0 THEN 'image/png; charset=x' WHEN 1 THEN ' IMAGE/JPEG ' WHEN 2 THEN NULL ELSE p_type END AS mime FROM {part}"
)

_BASE = "regexp_extract(regexp_replace(v, '(/\\.?)+$', ''), '([^/]*)$', 1)"


@query("sanitize_filename", f"""
WITH s AS (SELECT id, trim({_BASE}) AS base FROM {sub(FILES)}),
f AS (SELECT id, base, trim(regexp_replace(base, '[^A-Za-z0-9._-]+', '_', 'g'), '._') AS safe FROM s),
x AS (SELECT *, CASE WHEN length(safe) > 1 AND strpos(substr(safe, 2), '.') > 0 THEN '.' || split_part(safe, '.', -1) ELSE '' END AS suffix FROM f),
e AS (SELECT *, CASE WHEN base IN ('', '.', '..') THEN 'filename is required' WHEN safe = '' THEN 'invalid filename'
  WHEN lower(suffix) NOT IN ('.jpg', '.jpeg', '.png') THEN 'allowed extensions: .jpg, .jpeg, .png' END AS error FROM x)
SELECT id, error, CASE WHEN error IS NULL THEN CASE WHEN length(safe) > 200
  THEN left(left(safe, length(safe) - length(suffix)), 200 - length(suffix)) || suffix ELSE safe END END AS name FROM e""")
def sanitize_filename(t: Tables):
    return t.bind(FILES).select("id", text.sanitize_file_name(c("v")).alias("s")).select("id", "s.error", "s.name")


@query("legacy_name", f"""SELECT id, CASE WHEN n NOT IN ('', '.', '..') THEN n END AS legacy FROM
(SELECT id, regexp_replace({_BASE}, '[<>:"/\\\\|?*\\x00-\\x1f]', '_', 'g') AS n FROM {sub(FILES)})""")
def legacy_name(t: Tables):
    return t.bind(FILES).select("id", text.legacy_name(c("v")).alias("legacy"))


@query("ext_from_mime", f"""SELECT id, CASE WHEN lower(trim(split_part(mime, ';', 1))) = 'image/png' THEN '.png' ELSE '.jpg' END AS ext FROM {sub(FILES)}""")
def ext_from_mime(t: Tables):
    return t.bind(FILES).select("id", text.ext_from_mime(c("mime")).alias("ext"))


@query("date_from_name", f"SELECT id, nullif(regexp_extract(v, '(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), '') AS day FROM {sub(FILES)}")
def date_from_name(t: Tables):
    return t.bind(FILES).select("id", dates.date_from_name(c("v")).alias("day"))


PATHS = (
    "SELECT page_id AS id, CASE page_id % 8 WHEN 0 THEN url WHEN 1 THEN concat('/', url) WHEN 2 THEN concat('a/../', url) "
    "WHEN 3 THEN concat('C:', chr(92), 'share', chr(92), url) WHEN 4 THEN replace(url, '/', chr(92)) "
    "WHEN 5 THEN '   ' WHEN 6 THEN concat('x//', url, '/./y') ELSE concat(' d/Orders/', url, ' ') END AS v FROM {pages}"
)


@query("path_normalize", f"""
WITH p AS (SELECT id, replace(trim(v), chr(92), '/') AS v FROM {sub(PATHS)}),
q AS (SELECT id, v, list_filter(string_split(v, '/'), lambda s: s <> '') AS parts FROM p),
e AS (SELECT *, CASE WHEN v = '' THEN 'empty path' WHEN starts_with(v, '/') OR substr(v, 2, 1) = ':' THEN 'absolute path'
  WHEN len(parts) = 0 THEN 'empty path' WHEN list_contains(parts, '.') OR list_contains(parts, '..') THEN 'path traversal' END AS error FROM q)
SELECT id, error, CASE WHEN error IS NULL THEN array_to_string(parts, '/') END AS relpath FROM e""")
def path_normalize(t: Tables):
    return t.bind(PATHS).select("id", text.normalize_path(c("v")).alias("p")).select("id", "p.error", "p.relpath")


@query("path_after_marker", f"""
WITH p AS (SELECT id, replace(trim(v), chr(92), '/') AS v FROM {sub(PATHS)}),
q AS (SELECT id, v, strpos(lower(v), 'example') AS pos FROM p),
r AS (SELECT *, list_filter(string_split(substr(v, pos + 7), '/'), lambda s: s <> '') AS parts FROM q),
e AS (SELECT *, CASE WHEN v = '' THEN 'empty path' WHEN pos = 0 THEN 'no marker' WHEN len(parts) = 0 THEN 'ends at marker'
  WHEN list_contains(parts, '.') OR list_contains(parts, '..') THEN 'path traversal' END AS error FROM r)
SELECT id, error, CASE WHEN error IS NULL THEN array_to_string(parts, '/') END AS relpath FROM e""")
def path_after_marker(t: Tables):
    made = text.path_after_marker(c("v"), "Example")
    return t.bind(PATHS).select("id", made.alias("p")).select("id", "p.error", "p.relpath")


@query("scoped_ids", f"""SELECT id, 'point:' || id AS scoped, CASE WHEN service = 'A' THEN business_id END AS permit_id,
CASE WHEN service = 'N' THEN business_id END AS earthwork_id, CASE WHEN service = 'R' THEN business_id END AS repair_id FROM {sub(b.LAYER_ROWS)}""")
def scoped_ids(t: Tables):
    place = {"permit_id": "A", "earthwork_id": "N", "repair_id": "R"}
    return t.bind(b.LAYER_ROWS).select(
        "id", text.scoped_id("point", c("id")).alias("scoped"),
        *[F.when(c("service") == s, c("business_id")).alias(column) for column, s in place.items()],
    )


@query("scoped_regex", f"""SELECT key, coalesce(regexp_matches(permit_id, '^(point|line|polygon):'), false) AS scoped FROM {sub(b.ITEMS)}""")
def scoped_regex(t: Tables):
    return t.bind(b.ITEMS).select("key", text.is_true(text.is_scoped(c("permit_id"))).alias("scoped"))


@query("deterministic_key", f"""SELECT id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS key
FROM (SELECT id, md5(business_id) AS h FROM {sub(b.LAYER_ROWS)})""")
def deterministic_key(t: Tables):
    return t.bind(b.LAYER_ROWS).select("id", text.item_key(c("business_id")).alias("key"))


@query("content_hash", "SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256 FROM documents")
def content_hash(t: Tables):
    body = F.encode("text", "utf-8")
    return t.documents.select("doc_id", F.md5(body).alias("md5"), F.sha2(body, 256).alias("sha256"))


@query("nfc_name", "SELECT doc_id, nfc_normalize(text) AS name FROM documents")
def nfc_name(t: Tables):
    return t.documents.select("doc_id", text.nfc(c("text")).alias("name"))


@query("array_funcs", f"""SELECT key, list_contains(a, 'etl') AS owned, CAST(len(a) AS INTEGER) AS size, a[1] AS first FROM
(SELECT key, CASE WHEN o_custkey % 2 = 0 THEN [owner, key] ELSE [key, owner, 'x'] END AS a FROM {sub(b.ITEMS)})""")
def array_funcs(t: Tables):
    stamp = F.when(c("o_custkey") % 2 == 0, F.array("owner", "key")).otherwise(F.array(c("key"), c("owner"), F.lit("x")))
    return t.bind(b.ITEMS).select("key", stamp.alias("a")).select(
        "key", F.array_contains("a", "etl").alias("owned"), F.size("a").alias("size"), F.get("a", F.lit(0)).alias("first")
    )


# --- dates -------------------------------------------------------------------------------------

_PARSED = """CASE WHEN regexp_matches(trim(text_date), '^\\d{4}-\\d{2}-\\d{2}$') THEN CAST(try_strptime(trim(text_date), '%Y-%m-%d') AS DATE)
WHEN regexp_matches(trim(text_date), '^\\d{2}\\.\\d{2}\\.\\d{4}$') THEN CAST(try_strptime(trim(text_date), '%d.%m.%Y') AS DATE)
WHEN regexp_matches(trim(text_date), '^\\d{2}\\.\\d{2}\\.\\d{2}$') THEN CAST(try_strptime(substr(trim(text_date), 1, 6) ||
  CASE WHEN substr(trim(text_date), 7, 2) >= '70' THEN '19' ELSE '20' END || substr(trim(text_date), 7, 2), '%d.%m.%Y') AS DATE) END"""
AS_OF = "1998-06-15"


@query("parse_text_date", f"SELECT id, CAST({_PARSED} AS VARCHAR) AS day FROM {sub(b.DATED)}")
def parse_text_date(t: Tables):
    return t.bind(b.DATED).select("id", dates.parse_text_date(c("text_date")).cast("string").alias("day"))


SHEET = (
    "SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN CAST(34000 + o_orderkey % 3000 AS STRING) "
    "WHEN 1 THEN concat(CAST(day(o_orderdate) AS STRING), '/', CAST(month(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) AS STRING)) "
    f"WHEN 2 THEN {b.iso('o_orderdate')} WHEN 3 THEN concat(' ', {b.dotted('o_orderdate')}) WHEN 4 THEN CAST(o_orderkey % 70 AS STRING) "
    "ELSE o_orderpriority END AS v FROM {orders}"
)


@query("multi_format_date", f"""
WITH s AS (SELECT id, trim(v) AS v FROM {sub(SHEET)}), n AS (SELECT *, TRY_CAST(v AS INTEGER) AS serial FROM s)
SELECT id, CAST(CASE WHEN serial >= 60 THEN DATE '1899-12-30' + serial WHEN serial >= 1 THEN DATE '1899-12-30' + serial + 1
  ELSE CAST(coalesce(try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%d.%m.%Y'), try_strptime(v, '%d/%m/%Y')) AS DATE) END AS VARCHAR) AS day FROM n""")
def multi_format_date(t: Tables):
    return t.bind(SHEET).select("id", dates.multi_format_date(c("v")).cast("string").alias("day"))


EXIF = (
    "SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN concat(replace(" + b.iso("o_orderdate") + ", '-', ':'), ' 10:20:30') "
    "WHEN 1 THEN concat(' ', " + b.iso("o_orderdate") + ", ' 23:59:59') WHEN 2 THEN " + b.iso("o_orderdate") + " ELSE 'none' END AS v, "
    "o_orderkey % 90 AS deg, o_custkey % 60 AS mins, o_orderkey % 3600 AS sec_n, o_orderkey % 7 AS sec_d, "
    "CASE o_orderkey % 5 WHEN 0 THEN 'N' WHEN 1 THEN ' s ' WHEN 2 THEN 'W' WHEN 3 THEN 'E' END AS ref FROM {orders}"
)


@query("exif_date", f"""SELECT id, CAST(CAST(coalesce(try_strptime(trim(v), '%Y:%m:%d %H:%M:%S'), try_strptime(trim(v), '%Y-%m-%d %H:%M:%S')) AS DATE) AS VARCHAR) AS day FROM {sub(EXIF)}""")
def exif_date(t: Tables):
    return t.bind(EXIF).select("id", dates.exif_date(c("v")).cast("string").alias("day"))


@query("dms_to_decimal", f"""SELECT id, round(CASE WHEN ref IS NULL THEN NULL ELSE (deg + mins / 60.0e0 + (sec_n / nullif(sec_d, 0)) / 3600.0e0)
  * CASE WHEN upper(trim(ref)) IN ('S', 'W') THEN -1 ELSE 1 END END, 6) AS degrees FROM {sub(EXIF)}""")
def dms_to_decimal(t: Tables):
    seconds = dates.rational(c("sec_n"), c("sec_d"))
    made = dates.dms_to_decimal(c("deg").cast("double"), c("mins").cast("double"), seconds, c("ref"))
    return t.bind(EXIF).select("id", F.round(made, 6).alias("degrees"))


@query("coord_key", f"SELECT id, round(lon / 7, 9) AS lon_key, round(lat / 7, 9) AS lat_key FROM {sub(b.POINTS)}")
def coord_key(t: Tables):
    return t.bind(b.POINTS).select(
        "id", dates.coord_key(c("lon") / 7).alias("lon_key"), dates.coord_key(c("lat") / 7).alias("lat_key")
    )


# --- JSON --------------------------------------------------------------------------------------

LOOSE = (
    "SELECT event_id AS id, CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN concat('{{''type'': ''', event_type, ''', ''flag'': True, ''none'': None}}') "
    "WHEN 2 THEN concat('[', CAST(event_id AS STRING), ']') WHEN 3 THEN 'not json' WHEN 4 THEN NULL "
    "ELSE concat('{{\"type\": \"', event_type, '\", \"user\": ', CAST(user_id AS STRING), '}}') END AS v FROM {events}"
)


@query("maybe_dict", f"""
WITH j AS (SELECT id, CASE WHEN id % 6 = 1 THEN replace(replace(replace(v, '''', '"'), 'True', 'true'), 'None', 'null') ELSE v END AS v FROM {sub(LOOSE)}),
o AS (SELECT id, CASE WHEN json_valid(v) THEN CASE WHEN json_type(v) = 'OBJECT' THEN v END END AS v FROM j)
SELECT id, v IS NOT NULL AS is_dict, json_extract_string(v, '$.type') AS type, json_extract_string(v, '$.k') AS k, json_extract_string(v, '$.flag') AS flag FROM o""")
def maybe_dict(t: Tables):
    return t.spread(LOOSE).select("id", jsonx.maybe_dict(c("v")).alias("d")).select(
        "id", c("d").isNotNull().alias("is_dict"),
        *[F.get_json_object("d", f"$.{k}").alias(k) for k in ("type", "k", "flag")],
    )


PERMITS = (
    "SELECT o_orderkey AS id, concat('{{\"datasetId\":', CAST(o_orderkey % 9 AS STRING), ',\"rowId\":\"r', CAST(o_orderkey AS STRING), "
    "'\",\"versionNumber\":\"\",\"OrderNumber\":\"flat\",\"geoData\":1,\"Дата\":2,\"id\":3,\"attributes\":{{\"OrderNumber\":\"', CAST(o_custkey AS STRING), "
    "'\",\"WorkType\":', CASE o_orderkey % 3 WHEN 0 THEN concat('[\"', o_orderpriority, '\"]') WHEN 1 THEN '\"text\"' ELSE '{{\"a\":1}}' END, "
    "',\"WorkEndDate\":\"', " + b.dotted("o_orderdate") + ", '\",\"global_id\":', CAST(o_orderkey * 3 AS STRING), "
    "CASE WHEN o_orderkey % 2 = 0 THEN concat(',\"totalPrice\":', CAST(o_custkey AS STRING), '.5') ELSE ',\"isOpen\":true' END, '}}}}') AS doc FROM {orders}"
)


@query("property_flatten", f"""
WITH d AS (SELECT id, doc FROM {sub(PERMITS)})
SELECT id, 'order_number' AS name, json_extract_string(doc, '$.attributes.OrderNumber') AS raw, 'str' AS kind FROM d
UNION ALL SELECT id, 'dataset_id', json_extract_string(doc, '$.datasetId'), 'int' FROM d
UNION ALL SELECT id, 'row_id', json_extract_string(doc, '$.rowId'), 'str' FROM d
UNION ALL SELECT id, 'version_number', '', 'str' FROM d
UNION ALL SELECT id, 'work_type', CASE WHEN id % 3 = 1 THEN json_extract_string(doc, '$.attributes.WorkType') ELSE CAST(json_extract(doc, '$.attributes.WorkType') AS VARCHAR) END, CASE WHEN id % 3 = 1 THEN 'str' ELSE 'json' END FROM d
UNION ALL SELECT id, 'work_end_date', json_extract_string(doc, '$.attributes.WorkEndDate'), 'str' FROM d
UNION ALL SELECT id, 'global_id', json_extract_string(doc, '$.attributes.global_id'), 'int' FROM d
UNION ALL SELECT id, 'total_price', json_extract_string(doc, '$.attributes.totalPrice'), 'float' FROM d WHERE id % 2 = 0
UNION ALL SELECT id, 'is_open', 'true', 'bool' FROM d WHERE id % 2 = 1""")
def property_flatten(t: Tables):
    members = jsonx.flatten_properties(c("doc"))
    return t.spread(PERMITS).select("id", F.explode(members).alias("m")).select("id", "m.*")


MIXED = (
    "SELECT event_id AS id, concat('{{\"i\":', CAST(event_id AS STRING), ',\"f\":', CASE WHEN user_id % 9 = 0 THEN concat(CAST(user_id AS STRING), '.25') ELSE CAST(user_id AS STRING) END, "
    "',\"b\":', CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END, ',\"bi\":', CASE WHEN event_type = 'click' THEN 'true' ELSE CAST(user_id AS STRING) END, "
    "',\"bf\":', CASE WHEN event_type = 'click' THEN 'true' ELSE '1.5' END, ',\"s\":', CASE WHEN event_type = 'view' THEN '7' ELSE concat('\"', event_type, '\"') END, "
    "',\"j\":', CASE WHEN event_id % 5 = 0 THEN '[1,2]' ELSE '\"x\"' END, ',\"n\":null}}') AS doc, event_type FROM {events}"
)
_TYPE_CASE = """CASE WHEN j THEN 'json' WHEN s THEN 'string' WHEN f THEN 'double' WHEN i AND NOT b THEN 'bigint' WHEN b AND NOT i THEN 'boolean' ELSE 'string' END"""
_FLAGS = """SELECT name, bool_or(ty IN ('ARRAY','OBJECT')) AS j, bool_or(ty = 'VARCHAR') AS s, bool_or(ty = 'DOUBLE') AS f,
 bool_or(ty IN ('BIGINT','UBIGINT')) AS i, bool_or(ty = 'BOOLEAN') AS b FROM"""


def _mixed_members(t: Tables, where: str | None = None):
    df = t.spread(MIXED)
    df = df.filter(where) if where else df
    return df.withColumn("members", jsonx.flatten_properties(c("doc")))


@query("infer_types", f"""SELECT name, {_TYPE_CASE} AS type FROM ({_FLAGS}
(SELECT name, json_type(doc, '$.' || name) AS ty FROM (SELECT doc, unnest(json_keys(doc)) AS name FROM {sub(MIXED)})) GROUP BY name)""")
def infer_types(t: Tables):
    return schema.infer_types(_mixed_members(t))


@query("schema_merge", f"""
WITH x AS (SELECT event_type, name, json_type(doc, '$.' || name) AS ty FROM (SELECT event_type, doc, unnest(json_keys(doc)) AS name FROM {sub(MIXED)})),
o AS (SELECT name, {_TYPE_CASE} AS old FROM ({_FLAGS} x WHERE event_type = 'click' GROUP BY name)),
n AS (SELECT name, {_TYPE_CASE} AS new FROM ({_FLAGS} x WHERE event_type <> 'click' GROUP BY name))
SELECT name, CASE WHEN old = 'json' OR new = 'json' THEN 'json' WHEN old = 'string' OR new = 'string' THEN 'string' WHEN old = 'double' OR new = 'double' THEN 'double'
 WHEN old = new THEN old ELSE 'string' END AS type FROM o JOIN n USING (name)""")
def schema_merge(t: Tables):
    old = schema.infer_types(_mixed_members(t, "event_type = 'click'"))
    new = schema.infer_types(_mixed_members(t, "event_type <> 'click'"))
    return schema.merge_types(old, new)


VALUES = (
    "SELECT event_id AS id, concat('{{\"v\":', CASE event_id % 8 WHEN 0 THEN CAST(event_id AS STRING) WHEN 1 THEN concat(CAST(user_id AS STRING), '.75') "
    "WHEN 2 THEN concat('\"', CAST(event_id AS STRING), '\"') WHEN 3 THEN concat('\"', event_type, '\"') WHEN 4 THEN CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END "
    "WHEN 5 THEN CASE WHEN user_id % 2 = 0 THEN '[]' ELSE '[1,2]' END WHEN 6 THEN 'null' ELSE CASE WHEN user_id % 2 = 0 THEN '0' ELSE '\"\"' END END, '}}') AS doc FROM {events}"
)


@query("typed_coerce", f"""
WITH v AS (SELECT id, json_type(doc, '$.v') AS ty, json_extract_string(doc, '$.v') AS s, CAST(json_extract(doc, '$.v') AS VARCHAR) AS raw FROM {sub(VALUES)})
SELECT id, CASE WHEN ty = 'NULL' THEN NULL WHEN ty = 'BOOLEAN' THEN s = 'true' WHEN ty = 'VARCHAR' THEN s <> '' WHEN ty = 'ARRAY' THEN raw <> '[]' ELSE CAST(s AS DOUBLE) <> 0 END AS as_bool,
CASE WHEN ty = 'BOOLEAN' THEN CASE WHEN s = 'true' THEN 1 ELSE 0 END WHEN ty = 'DOUBLE' THEN CAST(trunc(CAST(s AS DOUBLE)) AS BIGINT) WHEN ty IN ('UBIGINT','BIGINT') THEN CAST(s AS BIGINT)
  WHEN ty = 'VARCHAR' AND regexp_matches(s, '^[0-9]+$') THEN CAST(s AS BIGINT) END AS as_long,
CASE WHEN ty = 'BOOLEAN' THEN CASE WHEN s = 'true' THEN 1e0 ELSE 0e0 END WHEN ty IN ('ARRAY','NULL') THEN NULL ELSE TRY_CAST(s AS DOUBLE) END AS as_double,
CASE WHEN ty = 'NULL' THEN NULL WHEN ty = 'VARCHAR' THEN s ELSE raw END AS as_text,
CASE WHEN ty = 'NULL' THEN NULL ELSE raw END AS as_json FROM v""")
def typed_coerce(t: Tables):
    m = t.spread(VALUES).select("id", F.explode(jsonx.flatten_properties(c("doc"))).alias("m")).select("id", "m.*")
    wanted = {"as_bool": "boolean", "as_long": "bigint", "as_double": "double", "as_text": "string", "as_json": "json"}
    return m.select("id", *[jsonx.coerce(c("raw"), c("kind"), ty).alias(name) for name, ty in wanted.items()])


DOCS = (
    "SELECT event_id AS id, CASE event_id % 9 WHEN 0 THEN concat('{{\"wkt\":\"POINT (', CAST(37 + user_id % 2 AS STRING), ' 55)\",\"order_id\":\"o', CAST(event_id AS STRING), '\"}}') "
    "WHEN 1 THEN concat('{{\"uuids\":[\"a', CAST(event_id AS STRING), '\",\"b', CAST(user_id AS STRING), '\"],\"note\":\"n\"}}') "
    "WHEN 2 THEN concat('{{\"uuid\":\"u', CAST(event_id AS STRING), '\",\"upload_at\":\"2024\",\"date\":\"d\"}}') "
    "WHEN 3 THEN concat('{{\"lat\":', CAST(50 + user_id % 60 AS STRING), ',\"lng\":', CAST(30 + user_id % 9 AS STRING), '.5}}') "
    "WHEN 4 THEN concat('{{\"latitude\":\"55.5\",\"longitude\":', CAST(user_id AS STRING), '}}') WHEN 5 THEN concat('[', CAST(event_id AS STRING), ']') "
    "WHEN 6 THEN '{{\"wkt\":\" \",\"lat\":1}}' WHEN 7 THEN '{{\"lat\":null,\"lng\":4,\"latitude\":5,\"longitude\":6}}' ELSE props END AS doc FROM {events}"
)
_KIND = """CASE WHEN json_type(doc) <> 'OBJECT' THEN NULL WHEN json_type(doc, '$.wkt') = 'VARCHAR' AND trim(json_extract_string(doc, '$.wkt')) <> '' THEN 'order'
WHEN json_type(doc, '$.uuids') = 'ARRAY' THEN 'uuid_area'
WHEN json_extract_string(doc, '$.uuid') <> '' AND trim(json_extract_string(doc, '$.upload_at')) <> '' AND (json_exists(doc, '$.date') OR json_exists(doc, '$.lat')) THEN 'uploaded_photo'
WHEN json_exists(doc, '$.lat') AND json_exists(doc, '$.lng') THEN 'photo_meta'
WHEN NOT (json_exists(doc, '$.wkt') OR json_exists(doc, '$.uuids') OR json_exists(doc, '$.lat') OR json_exists(doc, '$.lng')) THEN 'upload' END"""


@query("doc_classify", f"SELECT id, {_KIND} AS kind FROM {sub(DOCS)}")
def doc_classify(t: Tables):
    return t.spread(DOCS).select("id", jsonx.classify_document(c("doc")).alias("kind"))


@query("json_docs_route", f"SELECT coalesce({_KIND}, 'reject') AS kind, count(*) AS n, min(id) AS first_id FROM {sub(DOCS)} GROUP BY 1")
def json_docs_route(t: Tables):
    routed = docs.route_docs(t.spread(DOCS))
    return routed.groupBy(F.coalesce("kind", F.lit("reject")).alias("kind")).agg(
        F.count("*").alias("n"), F.min("id").alias("first_id")
    )


@query("explode_uuids", f"""SELECT id, json_extract_string(doc, '$.note') AS note, json_extract_string(doc, '$.uuids[' || i || ']') AS uuid
FROM {sub(DOCS)}, range(2) r(i) WHERE json_type(doc, '$.uuids') = 'ARRAY'""")
def explode_uuids(t: Tables):
    areas = docs.route_docs(t.spread(DOCS)).filter("kind = 'uuid_area'")
    return docs.explode_ids(areas).select("id", F.get_json_object("doc", "$.note").alias("note"), "uuid")


@query("coord_parse", f"""
WITH k AS (SELECT id, CASE WHEN json_exists(doc, '$.lat') AND json_exists(doc, '$.lng') THEN 'lat' WHEN json_exists(doc, '$.latitude') AND json_exists(doc, '$.longitude') THEN 'latitude' END AS pair, doc FROM {sub(DOCS)}),
v AS (SELECT id, TRY_CAST(CASE pair WHEN 'lat' THEN json_extract_string(doc, '$.lat') ELSE json_extract_string(doc, '$.latitude') END AS DOUBLE) AS lat,
 TRY_CAST(CASE pair WHEN 'lat' THEN json_extract_string(doc, '$.lng') ELSE json_extract_string(doc, '$.longitude') END AS DOUBLE) AS lng FROM k WHERE pair IS NOT NULL)
SELECT k.id, CASE WHEN v.lat BETWEEN -90 AND 90 AND v.lng BETWEEN -180 AND 180 THEN v.lat END AS lat,
 CASE WHEN v.lat BETWEEN -90 AND 90 AND v.lng BETWEEN -180 AND 180 THEN v.lng END AS lng FROM k LEFT JOIN v ON k.id = v.id""")
def coord_parse(t: Tables):
    return docs.with_coords(t.spread(DOCS)).select("id", "lat", "lng")


@query("payload_merge", f"""SELECT event_id AS id, CAST(event_id AS VARCHAR) AS a, CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'r' END AS b, CAST(user_id AS VARCHAR) AS c,
CASE WHEN event_id % 3 = 0 THEN 'q' END AS d FROM events""")
def payload_merge(t: Tables):
    response = F.concat(F.lit('{"a":'), c("event_id"), F.lit(',"b":'), F.when(c("event_id") % 2 == 0, F.lit("null")).otherwise(F.lit('"r"')), F.lit("}"))
    request = F.concat(F.lit('{"a":0,"b":"z","c":'), c("user_id"), F.lit(',"d":'), F.when(c("event_id") % 3 == 0, F.lit('"q"')).otherwise(F.lit("null")), F.lit("}"))
    merged = t.events.select(c("event_id").alias("id"), jsonx.merge_payload(response, request).alias("m"))
    return merged.select("id", *[F.try_element_at("m", F.lit(k)).alias(k) for k in "abcd"])


_PERMIT_SQL = ", ".join(
    (
        f"CASE WHEN json_type(doc, '$.attributes.{m}') IN ('ARRAY','OBJECT') THEN CAST(json_extract(doc, '$.attributes.{m}') AS VARCHAR) END AS {col}"
        if col in docs.PERMIT_JSON
        else f"CAST(json_extract_string(doc, '$.attributes.{m}') AS BIGINT) AS {col}"
        if col == "global_id"
        else f"json_extract_string(doc, '$.attributes.{m}') AS {col}"
    )
    for col, m in docs.PERMIT_ATTRIBUTES.items()
)


@query("permit_flatten", f"""SELECT id, CAST(json_extract_string(doc, '$.datasetId') AS INTEGER) AS dataset_id, nullif(json_extract_string(doc, '$.rowId'), '') AS row_id,
nullif(json_extract_string(doc, '$.versionNumber'), '') AS version_number, nullif(json_extract_string(doc, '$.releaseNumber'), '') AS release_number, {_PERMIT_SQL} FROM {sub(PERMITS)}""")
def permit_flatten(t: Tables):
    return docs.flatten_permit(t.spread(PERMITS)).drop("doc")


ANSWERS = (
    "SELECT event_id AS id, concat('{{\"opening\":', CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END, ',\"legal\":null,\"image\":\"', event_type, '.jpg\",\"photo_coordinate\":{{\"lat\":', "
    "CAST(50 + user_id % 9 AS STRING), CASE WHEN event_id % 3 = 0 THEN '' ELSE concat(',\"lng\":', CAST(37 + user_id % 5 AS STRING), '.25') END, ',\"azimuth_deg\":', CAST(user_id AS STRING), "
    "'}},\"order\":{{\"source\":\"s\",\"date_start\":\"\",\"date_end\":\"2024-01-', lpad(CAST(event_id % 28 + 1 AS STRING), 2, '0'), '\"}},\"yolo\":{{\"label\":', CAST(event_id % 3 AS STRING), "
    "',\"votes\":[', CAST(event_id AS STRING), ',1]}}}}') AS doc FROM {events}"
)


@query("response_flatten", f"""SELECT id, json_extract_string(doc, '$.opening') = 'true' AS opening, json_extract_string(doc, '$.image') AS image,
CAST(json_extract_string(doc, '$.photo_coordinate.lat') AS DOUBLE) AS photo_lat, CAST(json_extract_string(doc, '$.photo_coordinate.lng') AS DOUBLE) AS photo_lng,
CAST(json_extract_string(doc, '$.photo_coordinate.azimuth_deg') AS INTEGER) AS photo_azimuth_deg, json_extract_string(doc, '$.order.source') AS order_source,
nullif(json_extract_string(doc, '$.order.date_start'), '') AS order_date_start, json_extract_string(doc, '$.order.date_end') AS order_date_end,
CAST(json_extract_string(doc, '$.yolo.label') AS INTEGER) AS yolo_label, CAST(json_extract(doc, '$.yolo.votes') AS VARCHAR) AS yolo_votes,
json_exists(doc, '$.photo_coordinate.lng') AS has_point FROM {sub(ANSWERS)}""")
def response_flatten(t: Tables):
    flat = docs.flatten_response(t.spread(ANSWERS))
    return flat.select(
        "id", "opening", "image", "photo_lat", "photo_lng", "photo_azimuth_deg", "order_source",
        c("order_date_start").cast("string").alias("order_date_start"), c("order_date_end").cast("string").alias("order_date_end"),
        "yolo_label", "yolo_votes", c("photo_geom").isNotNull().alias("has_point"),
    )


TYPES = (
    "SELECT event_id AS id, CASE event_id % 7 WHEN 0 THEN 'int8' WHEN 1 THEN 'BOOL' WHEN 2 THEN '_text' WHEN 3 THEN 'timestamptz' WHEN 4 THEN event_type WHEN 5 THEN 'numeric' ELSE 'varchar' END AS udt, "
    "CASE WHEN event_id % 7 = 2 THEN 'ARRAY' ELSE 'x' END AS data_type FROM {events}"
)


@query("type_map", f"""SELECT id, CASE lower(udt) WHEN 'int8' THEN 'bigint' WHEN 'bool' THEN 'boolean' WHEN 'timestamptz' THEN 'timestamp' WHEN 'numeric' THEN 'decimal(38,10)' WHEN 'varchar' THEN 'string'
ELSE CASE WHEN lower(data_type) = 'array' THEN 'array<string>' ELSE 'string' END END AS type FROM {sub(TYPES)}""")
def type_map(t: Tables):
    return t.bind(TYPES).select("id", schema.map_type(c("udt"), c("data_type")).alias("type"))


PAGES = (
    "SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN concat('{{\"features\":[', props, ',', props, ']}}') WHEN 1 THEN concat('{{\"data\":[', props, ']}}') "
    "WHEN 2 THEN concat('[', props, ',', props, ',', props, ']') WHEN 3 THEN concat('{{\"features\":5,\"Items\":[', props, ']}}') ELSE props END AS page FROM {events}"
)


@query("envelope_unwrap", f"""
WITH p AS (SELECT id, CASE WHEN json_type(page) = 'ARRAY' THEN json(page) WHEN json_type(page, '$.features') = 'ARRAY' THEN json_extract(page, '$.features')
 WHEN json_type(page, '$.data') = 'ARRAY' THEN json_extract(page, '$.data') WHEN json_type(page, '$.Items') = 'ARRAY' THEN json_extract(page, '$.Items') END AS list FROM {sub(PAGES)})
SELECT id, CAST(i AS INTEGER) AS idx, json_extract_string(list, '$[' || i || '].k') AS k FROM p, range(3) r(i) WHERE list IS NOT NULL AND i < json_array_length(list)""")
def envelope_unwrap(t: Tables):
    listed = t.spread(PAGES).select("id", F.posexplode(jsonx.unwrap_envelope(c("page"))).alias("idx", "f"))
    return listed.select("id", "idx", F.get_json_object("f", "$.k").alias("k"))


RESULTS = (
    "SELECT user_id, concat('f', CAST(user_id AS STRING), '.json') AS source_file, event_id, event_type, CAST(value AS BIGINT) AS speed FROM {events}"
)


@query("results_array_ingest", f"""SELECT 'r' || event_id AS result_id, CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS camera, 1700000000 + event_id AS create_timestamp,
strftime(to_timestamp(1700000000 + event_id) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS created_at, event_id % 4 <> 0 AS has_point, source_file, 'prov' AS provider FROM {sub(RESULTS)}""")
def results_array_ingest(t: Tables):
    element = F.concat(
        F.lit('{"id":"r'), c("event_id"), F.lit('","camera":"'), F.when(c("event_type") == "click", F.lit("  ")).otherwise(c("event_type")),
        F.lit('","create_timestamp":'), c("event_id") + 1700000000, F.lit(',"latitude":55.5'),
        F.when(c("event_id") % 4 == 0, F.lit("")).otherwise(F.lit(',"longitude":37.5')), F.lit(',"issues":[{"x":1}]}'),
    )
    # One file per event, several results of a file being a matter of the array alone.
    files = t.bind(RESULTS).select(
        "source_file", F.concat(F.lit('{"provider":"prov","results":['), element, F.lit("]}")).alias("value")
    )
    rows, _ = docs.parse_results(files)
    return rows.select(
        "result_id", "camera", "create_timestamp", F.date_format(F.to_utc_timestamp("created_at", F.current_timezone()), "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        c("geom").isNotNull().alias("has_point"), "source_file", "provider",
    )


PAYLOADS = (
    "SELECT event_id AS id, concat('u', CAST(user_id AS STRING)) AS path_uuid, CASE event_id % 4 WHEN 0 THEN concat('{{\"uuid\":\"u', CAST(user_id AS STRING), '\"}}') "
    "WHEN 1 THEN concat('{{\"uuid\":\"u', CAST(event_id AS STRING), '\"}}') WHEN 2 THEN props ELSE '[]' END AS body FROM {events}"
)


@query("payload_validate", f"""SELECT id, CASE WHEN json_type(body) <> 'OBJECT' THEN 'not an object' WHEN nullif(trim(json_extract_string(body, '$.uuid')), '') IS NULL THEN 'uuid is required'
WHEN json_extract_string(body, '$.uuid') <> path_uuid THEN 'uuid mismatch' END AS reason FROM {sub(PAYLOADS)}""")
def payload_validate(t: Tables):
    return docs.validate_payloads(t.bind(PAYLOADS)).select("id", "reason")


# --- filters and purge rules -------------------------------------------------------------------

@query("purge_by_date", f"""SELECT id, text_date FROM {sub(b.DATED)} WHERE NOT (o_orderstatus <> 'P' AND coalesce({_PARSED} <= DATE '{AS_OF}' - INTERVAL 1 MONTH, false))""")
def purge_by_date(t: Tables):
    table = t.bind(b.DATED).withColumn("tasked", c("o_orderstatus") == "P")
    tagged = purge.purge_date(table, "text_date", F.to_date(F.lit(AS_OF)))
    return tagged.filter("action <> 'delete'").select("id", "text_date")


@query("purge_by_year", f"""SELECT CASE WHEN coalesce(TRY_CAST(nullif(regexp_extract(text_date, '(\\d{{4}})', 1), '') AS INTEGER) < 1998, false) THEN 'delete' ELSE 'keep' END AS action, count(*) AS n
FROM {sub(b.DATED)} GROUP BY 1""")
def purge_by_year(t: Tables):
    return count_actions(purge.purge_year(t.bind(b.DATED), "text_date", F.to_date(F.lit(AS_OF))))


SITES = (
    "SELECT o_orderkey AS id, CASE o_orderpriority WHEN '1-URGENT' THEN ' Введён ' WHEN '2-HIGH' THEN 'Введен' WHEN '3-MEDIUM' THEN 'Работы не начаты' WHEN '5-LOW' THEN NULL ELSE 'Идут работы' END AS status, "
    "CASE WHEN o_custkey % 10 = 0 THEN 'Метро' ELSE 'Дороги' END AS category, CASE o_orderstatus WHEN 'F' THEN false WHEN 'O' THEN true END AS actual FROM {orders}"
)
_RULES = """coalesce(trim(status) IN ('Введён', 'Введен'), false) AS done, coalesce(trim(status) = 'Работы не начаты', false) AS not_started,
coalesce(trim(category) = 'Метро', false) AS metro, coalesce(NOT actual, false) AS not_actual"""


def _rules():
    return purge.site_rules(c("status"), c("category"), c("actual"))


@query("purge_or_rules", f"SELECT id FROM (SELECT id, {_RULES} FROM {sub(SITES)}) WHERE NOT (done OR not_started OR metro OR not_actual)")
def purge_or_rules(t: Tables):
    return purge.purge_any(t.bind(SITES), _rules()).filter("action = 'keep'").select("id")


@query("purge_or_preview", f"""SELECT count(*) FILTER (WHERE done) AS done, count(*) FILTER (WHERE not_started) AS not_started, count(*) FILTER (WHERE metro) AS metro,
count(*) FILTER (WHERE not_actual) AS not_actual, count(*) FILTER (WHERE done OR not_started OR metro OR not_actual) AS any_rule FROM (SELECT {_RULES} FROM {sub(SITES)})""")
def purge_or_preview(t: Tables):
    return purge.preview(t.bind(SITES), _rules())


@query("purge_by_age", """SELECT event_id FROM events WHERE NOT (ts < TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 14 DAY OR event_type = 'error')""")
def purge_by_age(t: Tables):
    rules = purge.report_rules(c("ts"), c("event_type"), F.lit("2024-01-25 00:00:00").cast(dict(t.events.dtypes)["ts"]), stale="error")
    return purge.purge_any(t.events, rules).filter("action = 'keep'").select("event_id")


STATES = (
    "SELECT o_orderkey AS id, CASE o_orderpriority WHEN '1-URGENT' THEN 'Истек' WHEN '2-HIGH' THEN ' Срок действия истек ' WHEN '3-MEDIUM' THEN 'ИСТЕК вчера' WHEN '5-LOW' THEN NULL ELSE 'Действует' END AS status FROM {orders}"
)


@query("purge_expired_status", f"""SELECT id, status FROM {sub(STATES)} WHERE NOT coalesce(trim(status) IN ('Истек', 'Срок действия истек') OR lower(trim(status)) LIKE '%истек%', false)""")
def purge_expired_status(t: Tables):
    return t.bind(STATES).filter(~purge.status_expired(c("status")))


WORDS = ("Éauouon", "THE", "eaux", "p.ing", "ouè", "Brand#1", "x_y")


@query("keyword_ilike_any", "SELECT doc_id FROM documents WHERE " + " OR ".join(f"contains(lower(text), lower('{w}'))" for w in WORDS))
def keyword_ilike_any(t: Tables):
    return t.documents.filter(text.match_any(c("text"), WORDS)).select("doc_id")


@query("label_in_list", "SELECT c_custkey, trim(c_mktsegment) AS label FROM customer WHERE trim(c_mktsegment) IN ('BUILDING', 'MACHINERY', 'яма')")
def label_in_list(t: Tables):
    label = F.trim("c_mktsegment")
    return t.customer.filter(label.isin("BUILDING", "MACHINERY", "яма")).select("c_custkey", label.alias("label"))


@query("complete_rows", f"SELECT id FROM {sub(NAMES)} WHERE nullif(trim(v), '') IS NOT NULL AND nullif(trim(w), '') IS NOT NULL")
def complete_rows(t: Tables):
    return t.bind(NAMES).filter(text.strip_to_null(c("v")).isNotNull() & text.strip_to_null(c("w")).isNotNull()).select("id")


@query("null_safe_predicates", f"""SELECT key, coalesce(field_observed, false) AS is_true, field_observed IS NOT TRUE AS is_not_true, field_observed IS DISTINCT FROM is_office_task AS is_distinct FROM {sub(b.ITEMS)}""")
def null_safe_predicates(t: Tables):
    return t.bind(b.ITEMS).select(
        "key", text.is_true(c("field_observed")).alias("is_true"), text.is_not_true(c("field_observed")).alias("is_not_true"),
        text.is_distinct(c("field_observed"), c("is_office_task")).alias("is_distinct"),
    )


@query("prefix_not_like", f"""SELECT key FROM {sub(b.ITEMS)} WHERE (permit_id IS NULL OR permit_id NOT LIKE 'point:%') AND o_custkey > 100""")
def prefix_not_like(t: Tables):
    return t.bind(b.ITEMS).filter(text.not_prefix_or_null(c("permit_id"), "point:") & (c("o_custkey") > 100)).select("key")


READY = (
    "SELECT event_id AS id, CASE event_id % 6 WHEN 0 THEN 'a.csv' WHEN 1 THEN '~$a.csv' WHEN 2 THEN 'a.csv.tmp' WHEN 3 THEN 'A.CSV' WHEN 4 THEN 'a.txt' ELSE 'b.part' END AS name, user_id AS age FROM {events}"
)


@query("ready_files", f"SELECT id, name FROM {sub(READY)} WHERE name IN ('a.csv', 'A.CSV') AND age >= 2")
def ready_files(t: Tables):
    from geosync.sources.files import is_ready

    now = F.timestamp_seconds(F.lit(1_700_000_000))
    made = t.bind(READY).withColumn("modified", F.timestamp_seconds(F.lit(1_700_000_000) - c("age")))
    return made.filter(is_ready(c("name"), c("modified"), now, (".csv",))).select("id", "name")


@query("filtered_counts", f"""SELECT count(*) AS total, count(*) FILTER (WHERE permit_id LIKE 'point:%') AS points, count(*) FILTER (WHERE permit_id LIKE 'line:%') AS lines,
count(*) FILTER (WHERE field_observed) AS observed FROM {sub(b.ITEMS)}""")
def filtered_counts(t: Tables):
    tests = {
        "points": c("permit_id").startswith("point:"), "lines": c("permit_id").startswith("line:"), "observed": c("field_observed"),
    }
    return audit.filtered_counts(t.bind(b.ITEMS), tests)
