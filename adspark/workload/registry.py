"""Named queries, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adspark.workload.sql import with_views
from adspark.workload.tables import Source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str):
    """Register a function of :class:`Source`. ``views`` are the SQL views the text starts from."""

    def register(fn: Callable[[Source], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Source(spark, folder))

        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(sql, *views) if views else sql
        return fn

    return register


def once(fn: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
    """Build a shared step once per :class:`Source`, so that its readers hold the same plan."""

    def get(s: Source) -> DataFrame:
        key = f"_step_{fn.__name__}"
        if key not in s.__dict__:
            s.__dict__[key] = fn(s)
        return s.__dict__[key]

    return get
