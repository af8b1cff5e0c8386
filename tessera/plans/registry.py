"""Registry of named queries and their DuckDB oracle SQL.

Query modules register with ``@query(name, sql)``; ``sql`` may mention
the fixture tables (``x_orders`` …), whose CTEs are prepended
automatically.  ``sql=None`` marks an operator that is not expressible
in SQL (checked by row count and by tests instead).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.fixture_sql import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

_MODULES = [
    "tessera.plans.q_star",
    "tessera.plans.q_quality",
    "tessera.plans.q_analysis",
    "tessera.plans.q_stats",
    "tessera.plans.q_series",
    "tessera.plans.q_classify",
    "tessera.plans.q_io",
]


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_fixtures(sql, extra)
        return fn
    return deco


_loaded = False


def load_all() -> None:
    global _loaded
    if _loaded:
        return
    for m in _MODULES:
        try:
            importlib.import_module(m)
        except ModuleNotFoundError as e:
            if e.name != m:
                raise
    _loaded = True


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
