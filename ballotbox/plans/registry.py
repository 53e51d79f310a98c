"""Registry of named queries: Spark builder plus its DuckDB oracle SQL."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    oracle: Callable[[], str] | None
    operator: str


QUERIES: dict[str, Query] = {}


def register(name: str, operator: str, oracle: Callable[[], str] | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, oracle, operator)
        return fn
    return wrap


def load_all() -> dict[str, Query]:
    # Importing the modules fills the registry.
    from ballotbox.plans import q_core, q_quality, q_probes, q_docs, q_io  # noqa: F401
    return QUERIES
