"""Registry of queries (Spark callables) and their DuckDB oracle SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register fn(spark, sf_dir) -> DataFrame under name, with an optional oracle SQL string."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def R(c) -> Column:
    """Round a computed double to 6 places (sum order differs between engines)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def load_all() -> None:
    from marquee.plans import (q_features, q_ingest, q_split, q_retrieval, q_losses,  # noqa: F401
                               q_lookup, q_metrics, q_sources, q_stream)
