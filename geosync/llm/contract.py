"""Queries of this subpackage, each over its whole tables, and the SQL that can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geosync.llm import bpe, chats, clustering, fertility, jaccard, language, licenses, neighbours, packing, quality, repeats, sharding, vectorcodes

_QUERIES = (
    neighbours.op1_inverted_multi_index,
    sharding.op2_permutation_sharding,
    bpe.op3_bpe_round_trip,
    quality.op4_co_training_quality,
    language.op5_rank_order_language,
    repeats.op6_bwt_interval_dedup,
    licenses.op7_license_similarity_join,
    fertility.op8_tokeniser_fertility,
    packing.op9_order_preserving_packing,
    jaccard.op10_multi_order_jaccard,
    vectorcodes.op11_equal_average_codes,
    clustering.op12_vantage_point_clustering,
    chats.op13_event_sourced_chats,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {function.__name__: function for function in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_permutation_sharding": sharding.op2_sql(),
        "op11_equal_average_codes": vectorcodes.op11_sql(),
        "op12_vantage_point_clustering": clustering.op12_sql(),
        "op13_event_sourced_chats": chats.op13_sql(),
    }
