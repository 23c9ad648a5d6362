"""Query registry: name -> (Spark callable, oracle SQL or None).

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
full tables in ``sf_dir``.  The oracle SQL is an independent formulation of
the same result for DuckDB, built from the same fixture SQL text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from spark_ledger.plans import (queries_core, queries_portfolio, queries_retirement, queries_ingest,  # noqa: F401
                                    queries_reports, queries_context, queries_tables)
