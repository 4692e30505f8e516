"""Registered queries: a Spark function over the given tables and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geosync.session import spread

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The tables of one scale, opened when first named; ``bind`` reads a shared SELECT text."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def bind(self, text: str) -> DataFrame:
        used = {name: getattr(self, name) for name in TABLES if "{" + name + "}" in text}
        return self.spark.sql(text, **used)

    def spread(self, text: str) -> DataFrame:
        """Like ``bind``, over all cores, for queries with much work per row."""
        return spread(self.bind(text))


def sub(text: str) -> str:
    """The same SELECT text as a subquery for the oracle."""
    return "(" + text.format(**{name: name for name in TABLES}) + ")"


def query(name: str, sql: str | None = None):
    """Registers ``function(tables)``; ``sql`` is the oracle text, None for a rows-only check."""

    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register
