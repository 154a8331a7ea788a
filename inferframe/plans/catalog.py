"""Query catalogue: every registered query is ``fn(spark, sf_dir) -> DataFrame`` plus, where
the semantics are SQL-expressible, the equivalent DuckDB SQL over the same tables."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

MODULES = ["q_retrieval", "q_requests", "q_responses", "q_chat", "q_validate", "q_pages",
           "q_sources", "q_streams"]


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with its oracle SQL (None = rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES and QUERIES[name] is not fn:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so the registry is filled."""
    for m in MODULES:
        importlib.import_module(f"inferframe.plans.{m}")
