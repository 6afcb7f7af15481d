"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from airwave.sources.views import Views, with_views

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None, recursive: bool = False) -> Callable:
    """Register a function of the views under a name, with the body of its oracle over the same views."""

    def keep(fn: Callable[[Views], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql:
            ORACLES[name] = with_views(views, sql, recursive)
        return fn

    return keep
