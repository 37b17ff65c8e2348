"""The library's own queries (no training-data operators) with their SQL equivalents."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is the equivalent statement for the oracle."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep
