"""Registry of named queries: each is ``fn(spark, sf_dir) -> DataFrame`` plus an
optional DuckDB-runnable SQL oracle over the same parquet tables."""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

PLAN_MODULES = (
    "leaders", "basics", "keys_sets", "joins_aggs", "windows_sort", "warehouse",
    "nested", "features", "models", "streaming_plans",
)


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    for m in PLAN_MODULES:
        importlib.import_module(f"diamondlake.plans.{m}")


def queries() -> dict[str, Callable]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
