"""Data-quality checks that replace warehouse constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dq_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def dq_foreign_key(fact: DataFrame, fk: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact rows whose (non-NULL) foreign key has no dimension row."""
    return fact.filter(F.col(fk).isNotNull()).join(dim.select(F.col(dim_key).alias(fk)), fk, "left_anti")


def dq_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """D3: NULL count per column (long form), one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.selectExpr(f"stack({len(cols)}, " + ", ".join(f"'{c}', `{c}`" for c in cols)
                           + ") AS (column_name, null_count)")


def dq_domain(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violation count per named rule (rule = predicate that flags a bad row),
    e.g. ``length(name) > 18`` or ``abs(x) >= 10^(p-s)`` for NUMERIC(p, s)."""
    wide = df.agg(*[F.count_if(pred).alias(name) for name, pred in rules.items()])
    return wide.selectExpr(f"stack({len(rules)}, " + ", ".join(f"'{n}', `{n}`" for n in rules)
                           + ") AS (rule, violations)")


def numeric_overflow(col: str, precision: int, scale: int) -> Column:
    return F.abs(F.col(col)) >= 10 ** (precision - scale)


def varchar_overflow(col: str, n: int) -> Column:
    return F.length(F.col(col)) > n


def all_of(*c: Column) -> Column:
    return reduce(lambda a, b: a & b, c)
