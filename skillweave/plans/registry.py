"""All queries of the labour-market operators, with their DuckDB twins."""

from __future__ import annotations

from skillweave.plans import flows, history, relevance, reports, text

_MODULES = (reports, history, relevance, text, flows)


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
