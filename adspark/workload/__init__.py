"""The operators run on the star-schema test tables, each with the same query in plain SQL."""

from __future__ import annotations

from importlib import import_module

from adspark.workload.registry import QUERIES, SQL

_MODULES = ("relational", "measurement", "reports", "files")


def _load() -> None:
    for name in _MODULES:
        import_module(f"adspark.workload.{name}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
