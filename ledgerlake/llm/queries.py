"""Registered queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import chat_snapshots, shingle_join, source_divergence
from ledgerlake.llm.fingerprints import op3_document_fingerprints
from ledgerlake.llm.language_id import op9_language_id
from ledgerlake.llm.nbest_pieces import op10_nbest_pieces
from ledgerlake.llm.near_dedup import op6_minhash_near_dedup
from ledgerlake.llm.packing import op8_best_fit_packing
from ledgerlake.llm.quality_classifier import op7_quality_classifier
from ledgerlake.llm.quality_rules import op4_quality_rules
from ledgerlake.llm.token_counts import op1_token_counts
from ledgerlake.llm.turn_repair import op11_turn_repair
from ledgerlake.llm.url_filters import op2_url_filters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_url_filters": op2_url_filters,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_quality_rules": op4_quality_rules,
    "op5_chat_formatting": chat_snapshots.op5_chat_formatting,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_language_id": op9_language_id,
    "op10_nbest_pieces": op10_nbest_pieces,
    "op11_turn_repair": op11_turn_repair,
    "op12_source_divergence": source_divergence.op12_source_divergence,
    "op13_shingle_join": shingle_join.op13_shingle_join,
}

ORACLE_SQL: dict[str, str] = {
    "op5_chat_formatting": chat_snapshots.ORACLE,
    "op12_source_divergence": source_divergence.ORACLE,
    "op13_shingle_join": shingle_join.ORACLE,
}
