"""Registry of named queries over the test tables, each with its DuckDB oracle SQL.

A query is a function ``(spark, sf_dir) -> DataFrame`` built only from library
operators; its oracle is an independent SQL statement over the same tables
(``None`` where the operator is not expressible in SQL, e.g. a model fit).
Doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

QueryFn = Callable[..., "object"]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}
HEADLINE: list[str] = []


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        if headline:
            HEADLINE.append(name)
        return fn
    return deco
