"""All queries of the engine by name, and their SQL."""

from __future__ import annotations

from importlib import import_module

#: Modules of queries, in order.
FAMILIES = ("text_queries", "space_queries", "report_queries", "stage_queries", "context_queries")

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _family in FAMILIES:
    _module = import_module(f"curblake.plans.{_family}")
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.ORACLE_SQL
