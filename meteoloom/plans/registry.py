"""All queries of the forecast library with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import archive_queries, layout_queries, normal_queries, product_queries, stored_queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return product_queries.QUERIES | archive_queries.QUERIES | normal_queries.QUERIES | stored_queries.QUERIES | layout_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return product_queries.SQL | archive_queries.SQL | normal_queries.SQL | stored_queries.SQL | layout_queries.SQL
