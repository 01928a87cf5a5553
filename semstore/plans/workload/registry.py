"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
