"""Where queries register, with the DuckDB text each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from thalweg.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
