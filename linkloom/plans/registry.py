"""Public view of the query registry (imports every module that registers)."""

from __future__ import annotations

from . import queries as _batch  # noqa: F401  (registers batch queries)
from .queries import REGISTRY, Query, QueryFn

from . import file_queries as _files  # noqa: F401,E402  (registers file queries)
from ..streaming import queries as _streams  # noqa: F401,E402  (registers stream queries)


def queries() -> dict[str, QueryFn]:
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}


def get(name: str) -> Query:
    return REGISTRY[name]
