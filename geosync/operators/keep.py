"""One row per key, by partial aggregation: a hot key is reduced on every task before the shuffle.

``order`` is a list of plain columns, compared in turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_per(df: DataFrame, keys: list[Column], pick) -> DataFrame:
    names = [f"_k{i}" for i in range(len(keys))]
    grouped = df.groupBy(*[k.alias(n) for k, n in zip(keys, names)])
    return grouped.agg(pick(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("_row")).select("_row.*")


def latest_per(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The row with the greatest ``order`` for each key; ``order`` must tell all rows of a key apart."""
    return _one_per(df, keys, lambda row: F.max_by(row, F.struct(*order)))


def first_per(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The row with the least ``order`` for each key; ``order`` must tell all rows of a key apart."""
    return _one_per(df, keys, lambda row: F.min_by(row, F.struct(*order)))


def last_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Latest row per key, as row-by-row writing would leave it; rows with a NULL key all stay."""
    blank = F.lit(False)
    for key in keys:
        blank = blank | F.col(key).isNull()
    alone = F.when(blank, F.struct(*order))
    return latest_per(df, [*[F.col(k) for k in keys], alone], order)


def top_by(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows in ``order``; 0 means all rows."""
    ordered = df.orderBy(*order)
    return ordered.limit(n) if n else ordered
