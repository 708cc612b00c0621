"""Registered queries: each operator exercised on the supplied test tables.

``register(key, sql)`` records a ``(spark, sf_dir) -> DataFrame`` callable and, where SQL
can express the same result, an independent ANSI SQL oracle over the same tables.
Column names of the two agree; money is summed as decimal and returned as double.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MODULES = ["scans", "sinks", "predicates", "joins", "aggs", "windows", "sets", "functions",
           "hierarchy", "rules", "jobs", "registers"]


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn
    return deco


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    all_queries()
    return dict(ORACLES)
