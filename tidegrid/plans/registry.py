"""Names each query and pairs it with SQL for an independent engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def add(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load_all() -> None:
    from tidegrid.plans import (  # noqa: F401
        q_decisions,
        q_features,
        q_learning,
        q_monitoring,
        q_quality,
        q_sources,
        q_streaming,
    )
