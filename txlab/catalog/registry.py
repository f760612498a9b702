"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import pin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, folder) -> DataFrame`` and the SQL with the same result."""
    def add(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(pin(spark), folder)

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build
    return add
