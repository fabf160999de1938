"""Query registry: every key maps to a Spark callable ``(spark, sf_dir) -> DataFrame`` and,
where the result is expressible in SQL, the equivalent DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register ``fn`` under ``key``; ``sql`` is its oracle (omit for rows-only checks)."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every plan module so their ``@query`` registrations run."""
    from fulltime.plans import (  # noqa: F401
        core,
        shots_ratings,
        squads_features,
        scalars,
        serving,
        ml,
        streams,
        io,
    )
