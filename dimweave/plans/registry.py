"""Query registry: one named Spark query per operator, with its DuckDB
oracle statement where the result is SQL-expressible.

Every query takes ``(spark, sf_dir)``, reads the given Parquet tables
(through the fixture views) and returns a DataFrame whose column names
match the oracle statement's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dimweave.plans.fixture_sql import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register ``fn`` under ``name``; ``sql`` is its DuckDB oracle (fixture
    views are expanded to CTEs).  ``sql=None`` marks a rows-only check."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_fixtures(sql)
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from dimweave.plans import (  # noqa: F401
        q_datelist, q_metric_arrays, q_cumulative, q_scd, q_graph, q_facts,
        q_enrich, q_cleaning, q_audit, q_layout, q_sources, q_primitives,
    )
