"""All queries of the library and their SQL."""

from __future__ import annotations

from ledgerloom.plans import analysis, evaluation, general, projections, relations, text_search

_MODULES = (general, text_search, relations, analysis, projections, evaluation)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
SQL = {name: text for m in _MODULES for name, text in m.SQL.items()}
