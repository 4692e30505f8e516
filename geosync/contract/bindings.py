"""SELECT texts, valid in Spark and in the oracle alike, that read the given tables as geodata."""

from __future__ import annotations

_Y = "lpad(CAST(year({d}) AS STRING), 4, '0')"
_M = "lpad(CAST(month({d}) AS STRING), 2, '0')"
_D = "lpad(CAST(day({d}) AS STRING), 2, '0')"


def iso(d: str) -> str:
    return f"concat({_Y}, '-', {_M}, '-', {_D})".replace("{d}", d)


def dotted(d: str, short: bool = False) -> str:
    year = f"substr({_Y}, 3, 2)" if short else _Y
    return f"concat({_D}, '.', {_M}, '.', {year})".replace("{d}", d)


def text_date(d: str, key: str) -> str:
    """A date written in one of five ways, two of them unreadable."""
    return (
        f"CASE {key} % 5 WHEN 0 THEN {iso(d)} WHEN 1 THEN {dotted(d)} WHEN 2 THEN {dotted(d, True)} "
        f"WHEN 3 THEN '  ' ELSE concat('before ', {_Y.replace('{d}', d)}) END"
    )


# Orders with their date as text.
DATED = f"SELECT o_orderkey AS id, o_orderstatus, o_orderpriority, {text_date('o_orderdate', 'o_orderkey')} AS text_date FROM {{orders}}"

# Customers as points; the offset keeps them off cell borders.
POINTS = (
    "SELECT c_custkey AS id, c_name, c_mktsegment, c_nationkey, "
    "37.3e0 + (c_custkey % 997) * 6e-4 + 1e-5 AS lon, 55.5e0 + (c_custkey % 991) * 5e-4 + 1e-5 AS lat FROM {customer}"
)

# Nations as districts, five by five.
DISTRICTS = (
    "SELECT n_nationkey AS gid, n_name AS rayon, n_regionkey, 37.3e0 + 0.12e0 * (n_nationkey % 5) AS x0, "
    "55.5e0 + 0.1e0 * floor(n_nationkey / 5) AS y0, 37.3e0 + 0.12e0 * (n_nationkey % 5) + 0.12e0 AS x1, "
    "55.5e0 + 0.1e0 * floor(n_nationkey / 5) + 0.1e0 AS y1 FROM {nation}"
)

# Suppliers as areas: squares, some inside one district, some across a border.
SQUARES = (
    "SELECT s_suppkey AS key, s_name, s_nationkey, 37.31e0 + (s_suppkey % 53) * 0.0103e0 AS x0, "
    "55.51e0 + (s_suppkey % 47) * 0.0091e0 AS y0, 37.31e0 + (s_suppkey % 53) * 0.0103e0 + 0.02e0 AS x1, "
    "55.51e0 + (s_suppkey % 47) * 0.0091e0 + 0.015e0 AS y1 FROM {supplier}"
)

# Mirror merge: both sides come from orders, and each lacks some of the other's rows.
MIRROR_TARGET = (
    "SELECT o_orderkey AS id, o_custkey, o_totalprice, o_orderstatus, o_orderpriority, "
    "CAST(o_orderkey * 2 AS BIGINT) AS local_note FROM {orders} WHERE o_orderpriority <> '5-LOW'"
)
MIRROR_SOURCE = (
    "SELECT o_orderkey AS id, o_custkey, o_totalprice + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_totalprice, "
    "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_orderpriority "
    "FROM {orders} WHERE o_orderpriority <> '1-URGENT'"
)

# Line items as layer rows: service, layer, link.
LAYER_ROWS = (
    "SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS source_id, l_returnflag AS service, "
    "CASE WHEN l_linestatus = 'O' THEN 'points' WHEN l_linenumber % 2 = 0 THEN 'lines' ELSE 'polygons' END AS layer, "
    "l_quantity <> 7 AS has_geom, "
    "CASE WHEN l_orderkey % 3 <> 0 THEN concat('k', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) END AS task_key, "
    "concat(CASE WHEN l_linestatus = 'O' THEN 'point' WHEN l_linenumber % 2 = 0 THEN 'line' ELSE 'polygon' END, ':', "
    "CAST(l_orderkey * 10 + l_linenumber AS STRING)) AS business_id, l_partkey AS global_id, "
    "md5(CAST(l_suppkey % 3 AS STRING)) AS geom_hash FROM {lineitem}"
)

# Events as camera photos.
PHOTOS = (
    "SELECT event_id AS id, concat('u', CAST(event_id AS STRING)) AS uuid, user_id AS cam_id, "
    "event_type AS status, event_type = 'error' AS disruption, ts FROM {events}"
)

# Orders as work items.
ITEMS = (
    "SELECT concat('t', lpad(CAST(o_orderkey AS STRING), 10, '0')) AS key, "
    "CASE WHEN o_orderkey % 4 = 0 THEN concat('point:', CAST(o_orderkey AS STRING)) "
    "WHEN o_orderkey % 4 = 1 THEN concat('line:', CAST(o_orderkey AS STRING)) END AS permit_id, "
    "CASE WHEN o_orderkey % 4 = 2 THEN concat('polygon:', CAST(o_orderkey AS STRING)) END AS earthwork_id, "
    "CASE WHEN o_orderkey % 4 = 3 THEN CAST(o_orderkey AS STRING) END AS label_id, "
    "CASE o_orderpriority WHEN '1-URGENT' THEN true WHEN '2-HIGH' THEN false END AS field_observed, "
    "o_orderstatus = 'F' AS is_field_data, "
    "CASE o_orderstatus WHEN 'O' THEN false WHEN 'P' THEN true END AS is_office_task, "
    "CASE WHEN o_custkey % 3 = 0 THEN 'etl' ELSE 'user' END AS owner, o_orderkey, o_custkey FROM {orders}"
)
