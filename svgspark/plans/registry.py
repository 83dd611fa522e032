"""Registry of named queries (Spark DataFrame builders) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``, with optional oracle SQL."""

    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn

    return deco


def lit(s: str) -> str:
    """A SQL string literal (single quotes doubled)."""
    return "'" + s.replace("'", "''") + "'"
