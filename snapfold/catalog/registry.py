"""Where the catalog modules enter their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL if it has one."""

    def enter(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}.")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return enter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
