"""Where the queries of this subpackage register, with their DuckDB texts where SQL can express them."""

from __future__ import annotations

from thalweg.llm.common import prepared

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = lambda spark, sf_dir: fn(prepared(spark), sf_dir)
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
