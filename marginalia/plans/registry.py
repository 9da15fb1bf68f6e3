"""All queries and their checks by name."""

from __future__ import annotations

from . import extraction_queries, hierarchy_queries, link_queries, state_queries, text_queries

MODULES = (extraction_queries, hierarchy_queries, link_queries, text_queries, state_queries)


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def checks() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.CHECKS.items()}
