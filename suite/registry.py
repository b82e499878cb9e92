from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (Tables) -> DataFrame under its own name."""

    def add(build):
        from suite.tables import Tables

        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql:
            SQL[name] = sql
        return build

    return add
