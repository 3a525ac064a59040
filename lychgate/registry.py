"""All queries of the library, by name, with the SQL that gives the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_PLANS = ("relational", "linkage", "scalars", "extraction", "maintenance", "actuarial", "files", "forms", "streams", "rewriting")
_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a plan under a name; sql gives the same rows over the same tables."""

    def add(plan):
        _queries[name] = plan
        if sql:
            _sql[name] = sql
        return plan

    return add


def _load() -> None:
    for name in _PLANS:
        importlib.import_module(f"lychgate.plans.{name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["linkage_best"](spark, sf_dir)
