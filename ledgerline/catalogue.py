"""All registered queries of the library."""

from __future__ import annotations

from collections.abc import Callable

from .plans import controls, enrichment, reconciliation, retaining, schemas, seasons, writing  # noqa: F401  they register themselves
from .plans.registry import ORACLES, QUERIES


def queries() -> dict[str, Callable]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
