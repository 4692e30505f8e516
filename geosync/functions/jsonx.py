"""JSON text columns: loose objects, properties, types, coordinates, document kinds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geosync.functions.text import GEOMETRY_COLUMNS, let, strip_all, to_column_name

# Quoted strings and the text between them.
_TOKENS = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^'"]+"""


def kind_of(value: Column) -> Column:
    """``null``, ``json``, ``str``, ``int``, ``float`` or ``bool`` for a variant."""

    def named(schema: Column) -> Column:
        return (
            F.when(schema.isNull() | (schema == "VOID"), F.lit("null"))
            .when(schema == "STRING", F.lit("str"))
            .when(schema == "BIGINT", F.lit("int"))
            .when(schema == "BOOLEAN", F.lit("bool"))
            .when(schema.startswith("ARRAY") | schema.startswith("OBJECT"), F.lit("json"))
            # Integers beyond 64 bits come back as wide decimals; a decimal point gives narrow ones.
            .when(schema.rlike(r"^DECIMAL\((19|[23]\d),0\)$"), F.lit("int"))
            .otherwise(F.lit("float"))
        )

    return let(F.schema_of_variant(value), named)


def _literal_to_json(text: Column) -> Column:
    """Python literal text rewritten as JSON: quotes, constants, tuples."""

    def rewrite(token: Column) -> Column:
        inner = F.substring(token, F.lit(2), F.length(token) - 2)
        inner = F.replace(inner, F.lit("\\'"), F.lit("'"))
        inner = F.replace(inner, F.lit('"'), F.lit('\\"'))
        bare = F.regexp_replace(token, r"\bTrue\b", "true")
        bare = F.regexp_replace(bare, r"\bFalse\b", "false")
        bare = F.regexp_replace(bare, r"\bNone\b", "null")
        bare = F.translate(bare, "()", "[]")
        return (
            F.when(token.startswith("'"), F.concat(F.lit('"'), inner, F.lit('"')))
            .when(token.startswith('"'), token)
            .otherwise(bare)
        )

    tokens = F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0))
    return F.array_join(F.transform(tokens, rewrite), "")


def maybe_dict(text: Column) -> Column:
    """JSON object text for an object given as JSON or as a Python literal; NULL for anything else."""

    def read(trimmed: Column) -> Column:
        literal = let(
            _literal_to_json(trimmed), lambda made: F.when(F.try_parse_json(made).isNotNull(), made)
        )
        return F.when(
            trimmed.startswith("{"),
            F.when(F.try_parse_json(trimmed).isNotNull(), trimmed).otherwise(literal),
        )

    def bare(given: Column) -> Column:
        # What begins and ends with braces has nothing to strip.
        return F.when(given.startswith("{") & given.endswith("}"), given).otherwise(strip_all(given))

    return let(let(text, bare), read)


_ENTRY_ARRAY = "array<struct<name:string,raw:string,kind:string>>"


def _entries(text: Column) -> Column:
    """Array of (name, raw, kind) for the members of an object, in order; empty when not an object."""

    def member(raw: Column, typed: Column, key: Column) -> Column:
        return F.struct(
            to_column_name(key).alias("name"),
            F.try_element_at(raw, key).alias("raw"),
            kind_of(F.try_element_at(typed, key)).alias("kind"),
        )

    parsed = F.struct(
        F.from_json(text, "map<string,string>").alias("raw"),
        F.from_json(text, "map<string,variant>").alias("typed"),
    )
    listed = let(
        parsed,
        lambda p: F.transform(F.map_keys(p["typed"]), lambda key: member(p["raw"], p["typed"], key)),
    )
    return F.coalesce(listed, F.array().cast(_ENTRY_ARRAY))


def flatten_properties(properties: Column) -> Column:
    """Flat and nested ``attributes`` members as one list of (name, raw, kind).

    Names are column names; a nested member replaces a flat one, a later one an earlier one.
    """
    flat = F.filter(
        _entries(properties),
        lambda e: ~F.coalesce(e["name"], F.lit("")).isin("geometry", "attributes"),
    )
    nested = let(maybe_dict(F.get_json_object(properties, "$.attributes")), _entries)
    every = F.filter(
        F.concat(flat, nested),
        lambda e: e["name"].isNotNull() & ~e["name"].isin(*GEOMETRY_COLUMNS),
    )

    def last_of_name(members: Column) -> Column:
        # A name's first place from the end is that of its last member; no list is copied for a member.
        return let(
            F.reverse(F.transform(members, lambda e: e["name"])),
            lambda names: F.filter(members, lambda e, i: F.array_position(names, e["name"]) + i == F.size(names)),
        )

    return let(every, last_of_name)


def type_of_flags(has_json: Column, has_other: Column, has_float: Column, has_int: Column,
                  has_bool: Column) -> Column:
    """Column type for the kinds of value seen: the order of the tests is the rule."""
    return (
        F.when(has_json, F.lit("json"))
        .when(has_other, F.lit("string"))
        .when(has_float, F.lit("double"))
        .when(has_int & ~has_bool, F.lit("bigint"))
        .when(has_bool & ~has_int, F.lit("boolean"))
        .otherwise(F.lit("string"))
    )


def merge_type(old: Column, kind: Column) -> Column:
    """Type after a further value of ``kind`` joins a column of type ``old``."""
    return type_of_flags(
        (old == "json") | (kind == "json"),
        (old == "string") | (kind == "str"),
        (old == "double") | (kind == "float"),
        (old == "bigint") | (kind == "int"),
        (old == "boolean") | (kind == "bool"),
    )


def truthy(raw: Column, kind: Column) -> Column:
    """Python truth of a member: empty text, zero, empty list and empty object are false."""
    return (
        F.when(kind == "null", None)
        .when(kind == "bool", raw == "true")
        .when(kind == "str", raw != "")
        .when(kind == "json", ~F.regexp_replace(raw, r"\s", "").isin("[]", "{}"))
        .otherwise(raw.try_cast("double") != 0)
    )


def coerce(raw: Column, kind: Column, type_name: str) -> Column:
    """A member as a value of a column type; NULL when it does not fit."""
    number = F.when(kind == "bool", F.when(raw == "true", 1).otherwise(0).cast("string")).when(
        kind.isin("int", "float", "str"), F.trim(raw)
    )
    if type_name == "json":
        # The writer escapes what JSON wants escaped; the array's brackets go.
        listed = F.to_json(F.array(raw))
        quoted = F.substring(listed, F.lit(2), F.length(listed) - 2)
        return F.when(kind == "null", None).when(
            kind == "str", F.coalesce(maybe_dict(raw), quoted)
        ).otherwise(raw)
    if type_name == "boolean":
        return truthy(raw, kind)
    if type_name == "bigint":
        whole = F.when((kind == "str") & ~number.rlike(r"^[+-]?\d+$"), None).otherwise(number)
        return F.coalesce(
            whole.try_cast("bigint"),
            F.when(kind == "float", number.try_cast("double").try_cast("bigint")),
        )
    if type_name == "double":
        return number.try_cast("double")
    return F.when(kind != "null", raw)


def finite(value: Column) -> Column:
    """The number, or NULL for NaN and infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def valid_wgs84(lat: Column, lng: Column) -> Column:
    return F.coalesce(
        finite(lat).between(-90.0, 90.0) & finite(lng).between(-180.0, 180.0), F.lit(False)
    )


def has_key(doc: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(doc), key), F.lit(False))


def parse_coords(doc: Column) -> Column:
    """``struct(lat, lng)`` from the first coordinate pair present; a bad pair gives NULL."""

    def pair(lat_key: str, lng_key: str) -> Column:
        lat = F.get_json_object(doc, f"$.{lat_key}").try_cast("double")
        lng = F.get_json_object(doc, f"$.{lng_key}").try_cast("double")
        return F.when(valid_wgs84(lat, lng), F.struct(lat.alias("lat"), lng.alias("lng")))

    return F.when(has_key(doc, "lat") & has_key(doc, "lng"), pair("lat", "lng")).when(
        has_key(doc, "latitude") & has_key(doc, "longitude"), pair("latitude", "longitude")
    )


def _member_kind(doc: Column, key: str) -> Column:
    return kind_of(F.try_variant_get(F.try_parse_json(doc), f"$.{key}", "variant"))


def classify_document(doc: Column) -> Column:
    """Kind of a JSON document by its members; NULL when no rule takes it."""
    is_object = F.json_object_keys(doc).isNotNull()
    filled = lambda key: (_member_kind(doc, key) == "str") & (
        strip_all(F.get_json_object(doc, f"$.{key}")) != ""
    )
    has = lambda key: has_key(doc, key)
    uuid_given = truthy(F.get_json_object(doc, "$.uuid"), _member_kind(doc, "uuid"))
    uuids = F.try_variant_get(F.try_parse_json(doc), "$.uuids", "variant")
    return F.when(
        is_object,
        F.when(F.coalesce(filled("wkt"), F.lit(False)), F.lit("order"))
        .when(F.coalesce(F.schema_of_variant(uuids).startswith("ARRAY"), F.lit(False)), F.lit("uuid_area"))
        .when(
            F.coalesce(uuid_given & filled("upload_at"), F.lit(False))
            & (has("date") | has("lat") | has("lng") | has("azimuth_deg")),
            F.lit("uploaded_photo"),
        )
        .when(has("lat") & has("lng"), F.lit("photo_meta"))
        .when(~(has("wkt") | has("uuids") | has("lat") | has("lng")), F.lit("upload")),
    )


_ENVELOPE = "features array<string>, data array<string>, Items array<string>"


def unwrap_envelope(payload: Column) -> Column:
    """Elements of a page as JSON text: a list under ``features``, ``data`` or ``Items``, or the list."""
    text = strip_all(payload)
    page = F.from_json(text, _ENVELOPE)
    return F.when(
        text.startswith("{"), F.coalesce(page["features"], page["data"], page["Items"])
    ).when(text.startswith("["), F.from_json(text, "array<string>"))


def merge_payload(response: Column, request: Column) -> Column:
    """Map in which the response wins and the request fills absent keys with its non-null values."""
    given = F.from_json(response, "map<string,string>")
    asked = F.from_json(request, "map<string,string>")
    extra = F.map_filter(asked, lambda k, v: v.isNotNull() & ~F.map_contains_key(given, k))
    return F.map_concat(given, extra)
