"""All registered queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from larder.session import tune

MODULES = ["relational", "aggregations", "discovery", "loading", "extraction", "searching", "postings", "names", "semantic", "streams"]


def _entries() -> dict[str, tuple[Callable, str | None]]:
    found: dict[str, tuple[Callable, str | None]] = {}
    for module in MODULES:
        found.update(import_module(f"larder.plans.{module}").ENTRIES)
    return found


def _tuned(fn: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(tune(spark), sf_dir.rstrip("/"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _tuned(fn) for name, (fn, _) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _entries().items() if sql is not None}
