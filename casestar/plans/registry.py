"""Registry of named queries: key -> (Spark builder, DuckDB oracle SQL).

A builder takes ``(spark, sf_dir)`` and returns a lazy ``DataFrame``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None) -> Callable[[Builder], Builder]:
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco
