"""All registered queries and their SQL counterparts, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from wardline.registry.compare import plain

PARTS = ("q_models", "q_gate", "q_state", "q_sources", "q_tests", "q_columns")


def _parts():
    return [import_module(f"wardline.registry.{p}") for p in PARTS]


def _plain(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(spark, sf_dir.rstrip("/")))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _plain(fn) for part in _parts() for name, fn in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _parts() for name, sql in part.ORACLE.items()}
