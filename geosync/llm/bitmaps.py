"""Bitmaps of fixed size that keep rows out of a shuffle when an exact join would drop or pass them anyway."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The bitmaps that thin out rows before an exact join have two to this power words, and at most two to that one.
MAP_BITS, MOST_BITS = 18, 20


def bits_for(keys: int) -> int:
    """The power of a map in which so many keys set an eighth of the bits, within the bounds."""
    return min(MOST_BITS, max(MAP_BITS, (keys // 8).bit_length()))


def marked(rows: DataFrame, key: str, wanted: DataFrame, how: str, bits: int = MAP_BITS) -> DataFrame:
    """``rows`` joined with a map of bits set by the one column of ``wanted``; ``_met`` says whether the bit of ``key`` is set."""

    def word(column: str) -> Column:
        return F.shiftrightunsigned(F.xxhash64(column), 64 - bits)

    def bit(column: str) -> Column:
        return F.expr(f"shiftleft(1L, CAST(pmod(xxhash64({column}), 64) AS INT))")

    name = wanted.columns[0]
    words = wanted.groupBy(word(name).alias("_word")).agg(F.bit_or(bit(name)).alias("_bits"))
    joined = rows.withColumn("_word", word(key)).join(F.broadcast(words), "_word", how)
    return joined.withColumn("_met", F.coalesce(F.col("_bits").bitwiseAND(bit(key)) != 0, F.lit(False))).drop("_word", "_bits")


def thinned(rows: DataFrame, key: str, wanted: DataFrame, bits: int = MAP_BITS) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among ``wanted`` (one column); none that is gets lost.

    The keys set bits of a map of 2^``bits`` words, which is broadcast; what passes still needs the exact join.
    """
    return marked(rows, key, wanted, "inner", bits).where("_met").drop("_met")


def without(rows: DataFrame, key: str, unwanted: DataFrame) -> DataFrame:
    """``rows`` less those whose ``key`` is among ``unwanted`` (one column of the same name). Only rows whose bit is set are shuffled."""
    rows = marked(rows, key, unwanted, "left")
    return rows.where("NOT _met").drop("_met").unionByName(rows.where("_met").drop("_met").join(unwanted, key, "left_anti"))
