"""All registered queries with their SQL counterparts."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boardlake.plans.views import with_views
from boardlake.session import ship_package

_MODULES = ["read_queries", "sync_queries", "delta_queries", "search_queries", "audit_queries", "stream_queries"]


def _loaded():
    return [importlib.import_module(f"boardlake.plans.{name}") for name in _MODULES]


def _prepared(function):
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _prepared(function) for module in _loaded() for key, function in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {
        key: with_views(sql, getattr(module, "ORACLE_VIEWS", None)) for module in _loaded() for key, sql in module.ORACLES.items()
    }
