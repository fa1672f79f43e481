"""The dicts behind the driver contract, filled by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.views_sql import with_views
from loadlens.demo.views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# The same queries over views that the caller has made, with stored sources or a stored hub.
OVER_VIEWS: dict[str, Callable[[Views], DataFrame]] = {}


def query(name: str, sql: str | None = None, ctes: dict[str, str] | None = None):
    """Register a function of the views under ``name``, with its DuckDB text if there is one."""

    def register(fn: Callable[[Views], DataFrame]):
        OVER_VIEWS[name] = fn
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql, ctes)
        return fn

    return register
