"""Query registry: ``queries()`` callables (spark, sf_dir) -> DataFrame and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from milesbase.plans.oracle_util import oracle

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, body: str | None = None, ctes: str = ""):
    """Register a query; ``body``/``ctes`` (DuckDB text) make its oracle, fixtures inlined."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if body is not None:
            ORACLES[name] = oracle(body, ctes)
        return fn
    return deco
