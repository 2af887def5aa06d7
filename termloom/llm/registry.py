"""Queries of this subpackage, and SQL where SQL can express them."""

from __future__ import annotations

from . import byte_bpe, chat, near_dups, neighbours, packing, quality_model, repetition, secrets, token_files, toxicity

QUERIES = {
    "op1_packing": packing.query,
    "op2_toxicity": toxicity.query,
    "op3_byte_bpe": byte_bpe.query,
    "op4_secrets": secrets.query,
    "op5_repetition": repetition.query,
    "op6_token_files": token_files.query,
    "op7_chat": chat.query,
    "op8_near_dups": near_dups.query,
    "op9_quality_model": quality_model.query,
    "op10_neighbours": neighbours.query,
}
ORACLE_SQL: dict[str, str] = {"op7_chat": chat.oracle_sql()}
