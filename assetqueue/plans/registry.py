"""Registry of named queries: Spark callable + output spec + DuckDB oracle."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from assetqueue.plans.spec import finalize, wrap_sql


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    spec: str | None
    sql: str | None
    check: str  # SQL / ROWS / PY


REGISTRY: dict[str, Entry] = {}


def register(name: str, spec: str | None = None, sql: str | None = None, check: str | None = None):
    """Decorator: ``fn(spark, sf_dir) -> DataFrame``; projected through ``spec``."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return finalize(df, spec) if spec else df

        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Entry(name, run, spec, sql, check or ("SQL" if sql else "ROWS"))
        return fn

    return deco


def queries() -> dict:
    _load()
    return {k: e.fn for k, e in REGISTRY.items()}


def oracle_sql() -> dict:
    _load()
    return {k: wrap_sql(e.sql, e.spec) for k, e in REGISTRY.items() if e.sql and e.spec}


def _load():
    # importing the catalog modules fills REGISTRY
    from assetqueue.plans import catalog_triage  # noqa: F401
    for mod in ("catalog_panel", "catalog_quality", "catalog_explore", "catalog_features",
                "catalog_metrics", "catalog_models", "catalog_similar", "catalog_views"):
        try:
            __import__(f"assetqueue.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"assetqueue.plans.{mod}":
                raise
