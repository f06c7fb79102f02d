"""Registry of queries and of the SQL that each is held against."""

from __future__ import annotations

from . import bridges, more, release_queries, releases, roundtrips, shapes, surface

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _module in (bridges, shapes, releases, surface, release_queries, roundtrips, more):
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.SQL
