"""The registered queries: each a library operator on the stand-in tables, with its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from standins.relations import Standins, oracle

Query = Callable[[Standins], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, build: Query, sql: str | None = None) -> None:
    QUERIES[name] = build
    if sql:
        ORACLES[name] = oracle(sql)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _on(build) for name, build in QUERIES.items()}


def _on(build: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Standins(spark, sf_dir))


# The modules below fill the catalogue.
from standins import (  # noqa: E402, F401
    ingest_queries,
    job_queries,
    lookup_queries,
    maintenance_queries,
    report_queries,
    scalar_queries,
)
