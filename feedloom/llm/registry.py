"""The queries of this subpackage, and their SQL."""

from __future__ import annotations

from . import chat_format, exact_dedup, language_id, lm_scoring, merkle, near_dedup, packing, phrases, sentence_pieces, sharding, token_counts, topk_search, toxicity

MODULES = (language_id, toxicity, topk_search, near_dedup, exact_dedup, sentence_pieces, lm_scoring, packing, sharding, token_counts, phrases, merkle, chat_format)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.ORACLES.items()}
