"""Registry of named queries: ``name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL | None)``.

Query modules register with the ``query`` decorator; ``__spark_entry__``
collects them.  A query without SQL is checked rows-only by the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, str] = {}   # query -> SURVEY ids it covers


def query(name: str, sql: str | None = None, ops: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        OPERATORS[name] = ops
        return fn
    return deco


MODULES = ("q_prepare", "q_features", "q_scoring", "q_models", "q_stats", "q_layout", "q_layered",
           "q_routing", "q_online", "q_streams", "q_trees")


def load_all() -> None:
    """Import every query module so they register."""
    import importlib
    import importlib.util
    for m in MODULES:
        full = f"churnlane.plans.{m}"
        if importlib.util.find_spec(full) is not None:
            importlib.import_module(full)
