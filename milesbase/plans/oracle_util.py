"""Build DuckDB oracle SQL: the fixture views are inlined as CTEs ahead of a query body."""

from __future__ import annotations

import re

from milesbase.sources.fixtures import FIXTURE_SQL, deps

_ORDER = list(FIXTURE_SQL)


def duck(sql_text: str) -> str:
    """Spark-flavoured fixture text -> DuckDB text (NTZ literal, relation braces)."""
    return re.sub(r"\{(\w+)\}", r"\1", sql_text.replace("TIMESTAMP_NTZ '", "TIMESTAMP '"))


def _needed(body: str) -> list[str]:
    need: set[str] = set()
    stack = [n for n in _ORDER if re.search(rf"\b{n}\b", body)]
    while stack:
        n = stack.pop()
        if n in need:
            continue
        need.add(n)
        stack.extend(d for d in deps(n) if d in FIXTURE_SQL)
    return [n for n in _ORDER if n in need]


def oracle(body: str, ctes: str = "") -> str:
    """``ctes``: extra ``name AS (...)`` definitions (comma separated) usable by ``body``."""
    body = duck(body)
    ctes = duck(ctes)
    names = _needed(ctes + "\n" + body)
    parts = [f"{n} AS ({duck(FIXTURE_SQL[n]).strip()})" for n in names]
    if ctes.strip():
        parts.append(ctes.strip())
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\nSELECT * FROM (\n" + body.strip() + "\n) oracle_q"
