"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, conversation, embedding_dedup, jaccard_join, language, merkle, packing, piece_bpe, quality, suffix_dedup, token_store, topk_search, toxicity
from .common import small_batches


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
        "op2_jaccard_join": jaccard_join.op2_jaccard_join,
        "op3_topk_search": topk_search.op3_topk_search,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_quality": quality.op5_quality,
        "op6_token_store": token_store.op6_token_store,
        "op7_language": language.op7_language,
        "op8_byte_bpe": byte_bpe.op8_byte_bpe,
        "op9_embedding_dedup": embedding_dedup.op9_embedding_dedup,
        "op10_packing": packing.op10_packing,
        "op11_conversation_repair": conversation.op11_conversation_repair,
        "op12_piece_bpe": piece_bpe.op12_piece_bpe,
        "op13_merkle_manifest": merkle.op13_merkle_manifest,
    }
    return {name: small_batches(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL expresses on whole tables."""
    return {
        "op1_suffix_dedup": suffix_dedup.OP1_SQL,
        "op2_jaccard_join": jaccard_join.OP2_SQL,
        "op3_topk_search": topk_search.OP3_SQL,
        "op9_embedding_dedup": embedding_dedup.OP9_SQL,
        "op11_conversation_repair": conversation.OP11_SQL,
        "op13_merkle_manifest": merkle.OP13_SQL,
    }
