"""Decorator that files a query together with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fusion_spark.catalog.views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None) -> Callable[[Query], Query]:
    """Registers ``fn(spark, sf_dir)``; ``views`` lists the views that ``sql`` reads."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = with_views(sql, *views.split()) if views else sql.strip()
        return fn

    return register
