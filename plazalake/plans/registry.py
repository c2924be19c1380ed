"""Named queries over the benchmark tables, each with its oracle where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plazalake.plans.oracle_sql import with_ctes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the decorated function under its own name."""

    def register(build: Query) -> Query:
        name = build.__name__
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return build

    return register


def load_all() -> None:
    from plazalake.plans import (  # noqa: F401
        bronze_queries,
        gold_queries,
        serving_queries,
        silver_queries,
        slo_queries,
        table_queries,
    )
