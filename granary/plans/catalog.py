"""All queries of the core operators with their DuckDB oracles."""

from __future__ import annotations

from granary.plans import claims, curation, ingest, matching, nested, selection, stats, store, text

MODULES = (selection, stats, store, claims, nested, text, matching, curation, ingest)


def queries() -> dict:
    return {name: run for m in MODULES for name, run in m.R.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.R.oracles.items()}
