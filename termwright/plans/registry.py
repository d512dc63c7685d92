"""Every query of the library by name, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from termwright.plans import audit_queries, catalog_queries, entry_queries, line_queries, match_queries, merge_queries, region_queries, retrieval_queries, rule_queries, selection_queries, sheet_queries, source_queries, text_queries

_MODULES = (text_queries, catalog_queries, match_queries, merge_queries, selection_queries, retrieval_queries, audit_queries, line_queries, rule_queries, region_queries, sheet_queries, entry_queries, source_queries)

QUERIES: dict[str, Callable] = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {name: q for m in _MODULES for name, q in m.ORACLE_SQL.items()}
