"""Column types found in the data, and rows cast to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosync.functions import jsonx

# Database type names and the Spark types for them.
TYPE_MAP = {
    "int4": "int", "int8": "bigint", "int2": "smallint", "float8": "double", "float4": "float",
    "bool": "boolean", "text": "string", "varchar": "string", "bpchar": "string", "json": "string",
    "jsonb": "string", "uuid": "string", "date": "date", "timestamp": "timestamp_ntz",
    "timestamptz": "timestamp", "numeric": "decimal(38,10)", "bytea": "binary", "geometry": "geometry",
}


def map_type(udt: Column, data_type: Column) -> Column:
    """Spark type for a database column; arrays become text arrays, unknown types text."""
    known = F.create_map(*[F.lit(x) for pair in TYPE_MAP.items() for x in pair])
    return F.coalesce(
        F.try_element_at(known, F.lower(udt)),
        F.when(F.lower(data_type) == "array", F.lit("array<string>")).otherwise(F.lit("string")),
    )


def infer_types(df: DataFrame, members: str = "members") -> DataFrame:
    """``name`` and ``type`` for every property seen, from all rows.

    ``members`` is the list :func:`geosync.functions.jsonx.flatten_properties` makes. Flags are
    combined on each task before the shuffle, which then carries one row per name and task.
    """
    # The outer form, as Spark would parse every row a second time to test a plain explode's list.
    seen = df.select(F.explode_outer(members).alias("m")).select("m.name", "m.kind").filter("name IS NOT NULL")
    has = lambda kind: F.max(F.col("kind") == kind)
    flags = seen.groupBy("name").agg(
        has("json").alias("j"), has("str").alias("s"), has("float").alias("f"), has("int").alias("i"),
        has("bool").alias("b"),
    )
    return flags.select(
        "name",
        jsonx.type_of_flags(F.col("j"), F.col("s"), F.col("f"), F.col("i"), F.col("b")).alias("type"),
    )


def merge_types(old: DataFrame, new: DataFrame) -> DataFrame:
    """``name`` and ``type`` of both maps; where both know a name the values seen are combined."""
    joined = old.select("name", F.col("type").alias("_o")).join(
        new.select("name", F.col("type").alias("_n")), "name", "full_outer"
    )
    kinds = F.create_map(
        *[F.lit(x) for pair in (("json", "json"), ("string", "str"), ("double", "float"), ("bigint", "int"),
                                ("boolean", "bool")) for x in pair]
    )
    merged = jsonx.merge_type(F.col("_o"), F.try_element_at(kinds, F.col("_n")))
    return joined.select(
        "name", F.when(F.col("_o").isNull(), F.col("_n")).when(F.col("_n").isNull(), F.col("_o")).otherwise(merged).alias("type")
    )


def type_list(types: DataFrame) -> list[tuple[str, str]]:
    """The inferred types on the driver: one entry per column name, sorted by name."""
    return sorted((row["name"], row["type"]) for row in types.collect())


def to_columns(df: DataFrame, types: list[tuple[str, str]], members: str = "members") -> DataFrame:
    """Properties as typed columns; JSON columns hold JSON text."""
    by_name = df.withColumn(
        "_by_name",
        F.map_from_entries(
            F.transform(
                members, lambda m: F.struct(m["name"], F.struct(m["raw"].alias("raw"), m["kind"].alias("kind")))
            )
        ),
    )
    columns = []
    for name, type_name in types:
        member = F.try_element_at(F.col("_by_name"), F.lit(name))
        columns.append(jsonx.coerce(member["raw"], member["kind"], type_name).alias(name))
    return by_name.select("*", *columns).drop("_by_name", members)
