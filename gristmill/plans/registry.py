"""Where queries and their SQL register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a (spark, sf_dir) function, with SQL for DuckDB over the same tables."""

    def put(f):
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"a query named {key} exists")
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
