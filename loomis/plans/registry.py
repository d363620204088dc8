"""Registered queries: each operator bound to the driver tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and, where SQL can express the
operator, ``ORACLE[name]`` holds the equivalent DuckDB statement over the
driver tables (same column names).  Modules add entries with ``register``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> tuple[dict[str, QueryFn], dict[str, str]]:
    # Importing the binding modules fills QUERIES / ORACLE.
    import importlib
    for mod in ["q_evaluate", "q_records", "q_corpus", "q_history", "q_curate", "q_sampling",
                "q_runs", "q_sources", "q_streams"]:
        try:
            importlib.import_module(f"loomis.plans.{mod}")
        except ModuleNotFoundError as e:  # module not written yet
            if e.name != f"loomis.plans.{mod}":
                raise
    return dict(QUERIES), dict(ORACLE)
