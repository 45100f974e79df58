"""Queries by name, and the SQL that checks them."""

from __future__ import annotations

from tickloom.plans import analytics, graph, integrity, operations, quality

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _m in (quality, analytics, integrity, graph, operations):
    QUERIES.update(_m.QUERIES)
    ORACLES.update(_m.ORACLES)
