"""All registered queries and their oracle SQL."""

from __future__ import annotations

from quarry.plans import analysis, pages, retrieval, tables

QUERIES = {}
ORACLES = {}

for _mod in (retrieval, pages, analysis, tables):
    for _name in dir(_mod):
        if _name.startswith("QUERIES_"):
            QUERIES.update(getattr(_mod, _name))
        elif _name.startswith("ORACLE_"):
            ORACLES.update(getattr(_mod, _name))
