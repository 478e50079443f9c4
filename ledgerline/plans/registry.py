"""Registration of queries, each with its SQL if SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function (spark, sf_dir) under its name."""
    def add(f: Callable) -> Callable:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return add
