"""Registered queries: one Spark callable per operator, with its DuckDB twin
where SQL can express the operator.

Every query reads the given tables (or data Spark derives from them) at the
``sf_dir`` it is called with, over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every catalog module (each registers its queries)."""
    from strainmeter.plans.catalog import (  # noqa: F401
        q_balance,
        q_clean,
        q_features,
        q_metrics,
        q_models,
        q_monitor,
        q_scoring,
        q_sources,
        q_streams,
    )


def queries() -> dict[str, Query]:
    load_all()
    return dict(REGISTRY)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
