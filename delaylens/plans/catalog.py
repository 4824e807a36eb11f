"""The query catalogue: each entry is a Spark job over the given tables, with
the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from delaylens.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a job under `name`."""

    def register(job: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return job(prepare(spark), sf_dir)

        run.__name__ = job.__name__
        run.__doc__ = job.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register


def load_all() -> None:
    """Imports every module that registers queries."""
    from delaylens.plans import (  # noqa: F401
        queries_aggregates,
        queries_features,
        queries_history,
        queries_joins,
        queries_metrics,
        queries_model,
        queries_scalars,
        queries_sources,
        queries_streaming,
        queries_warehouse,
    )
