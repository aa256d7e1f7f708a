"""Joins in which NULL keys meet each other, as NULLs form one group in GROUP BY and windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on ``keys``, NULL equal to NULL; each key column once."""
    other = right.withColumnsRenamed({k: f"__j_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__j_{k}")) for k in keys])
    return left.join(other, cond, how).drop(*[f"__j_{k}" for k in keys])
