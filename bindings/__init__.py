"""The operators applied to the test tables: name -> (query, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def bound(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that gives the same rows."""
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from bindings import cleaning, files, history, observe, quality, reshape, serving, stored  # noqa: E402,F401
