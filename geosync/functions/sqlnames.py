"""The text functions under names that SQL users can call, and item geometries as views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_FUNCTIONS = {
    "parse_text_date(v STRING) RETURNS DATE": r"""
        CASE WHEN trim(v) RLIKE r'^\d{4}-\d{2}-\d{2}($|[T ]\d{2}:)' THEN try_to_date(substr(trim(v), 1, 10), 'yyyy-MM-dd')
             WHEN trim(v) RLIKE r'^\d{2}\.\d{2}\.\d{4}$' THEN try_to_date(trim(v), 'dd.MM.yyyy')
             WHEN trim(v) RLIKE r'^\d{2}\.\d{2}\.\d{2}$' THEN try_to_date(
                 concat(substr(trim(v), 1, 6), if(substr(trim(v), 7, 2) >= '70', '19', '20'), substr(trim(v), 7, 2)), 'dd.MM.yyyy')
        END""",
    "extract_year(v STRING) RETURNS INT": r"try_cast(nullif(regexp_extract(v, r'(\d{4})', 1), '') AS INT)",
    "normalize_attr(v STRING) RETURNS STRING": r"""
        nullif(trim(regexp_replace(regexp_replace(regexp_replace(v, r'[\r\n]+', ' '), r'\s+', ' '), r'\s*-\s*', '-')), '')""",
    "normalize_label(v STRING) RETURNS STRING": r"""
        trim(BOTH '_' FROM regexp_replace(regexp_replace(normalize_attr(v), '[ -]+', '_'), '_+', '_'))""",
}


def register(spark: SparkSession) -> None:
    """Makes the functions known to this session's SQL."""
    for head, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


def register_geometries(found: DataFrame, best: DataFrame) -> None:
    """All geometries of items as ``item_geometries`` and one per item as ``item_geometry``."""
    found.createOrReplaceTempView("item_geometries")
    best.createOrReplaceTempView("item_geometry")
