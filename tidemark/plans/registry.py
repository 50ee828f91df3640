"""Query registry: name -> (spark callable, oracle SQL or None).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables; no limits, samples or id subsets. A call first writes the staged aggregates
it shares with other queries, where no query before it has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name`` with its oracle SQL."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, sql)
        return fn
    return deco


def _load():
    # Importing the modules registers their queries.
    from tidemark.plans import q_index, q_composite, q_series, q_misc, q_sources  # noqa: F401


def queries() -> dict[str, QueryFn]:
    """name -> callable(spark, sf_dir) returning a DataFrame; a call may write shared stages first."""
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    """name -> equivalent DuckDB SQL over the same tables."""
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def register_views(spark: SparkSession, sf_dir: str, names=None, prefix: str = "") -> list[str]:
    """Register queries as temporary views so they can be used from SQL:
    ``register_views(spark, dir, ["composite_total"])`` then
    ``spark.sql("SELECT * FROM composite_total WHERE composite_index > 50")``.
    A query that shares staged tables writes them when its view is registered; the
    views themselves are lazy plans over them."""
    qs = queries()
    chosen = list(qs) if names is None else list(names)
    for name in chosen:
        qs[name](spark, sf_dir).createOrReplaceTempView(prefix + name)
    return [prefix + n for n in chosen]
