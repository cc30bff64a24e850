"""Registry of named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sievemark.session import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the package goes to the executors with the first one, as tasks import it."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
