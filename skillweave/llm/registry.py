"""All queries of this subpackage, with their DuckDB twins."""

from __future__ import annotations

from skillweave.llm import bpe_replay, chat_format, collocations, decontaminate, jaccard_forest, line_dedup, line_frequency, pii_feistel, suffix_dedup, super_kmers, token_rollups, toxicity, whitening

_MODULES = (line_frequency, suffix_dedup, line_dedup, bpe_replay, token_rollups, decontaminate, jaccard_forest, chat_format, toxicity, pii_feistel, super_kmers, whitening, collocations)


def queries() -> dict:
    found: dict = {}
    for module in _MODULES:
        found |= module.QUERIES
    return found


def oracle_sql() -> dict[str, str]:
    found: dict = {}
    for module in _MODULES:
        found |= module.ORACLES
    return found
