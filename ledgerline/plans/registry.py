"""Where queries register themselves, each with its SQL for an independent engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a table reader: it gets t(name) -> DataFrame."""

    def register(build: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register
