"""Keys, deduplication and set operations.

Keep-first deduplication is an aggregate (``min_by`` over a struct of the
ordering columns) rather than ``row_number()``: it is deterministic, and a
group of copies that holds a large share of the rows is reduced map-side
before the shuffle instead of being sorted in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Text of a NULL key part.
NULL_PART = "\\N"


def _part(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(NULL_PART))


def key_concat(cols: list[str], sep: str = "-") -> Column:
    """K1: composite natural key as text; ``sep=''`` reproduces undelimited keys.
    A NULL part is written as ``NULL_PART``, so it keeps its place in the key."""
    return F.concat_ws(sep, *[_part(c) for c in cols])


def key_conditional(cond: Column, cols: list[str], sep: str = "-") -> Column:
    """K2: key only where ``cond`` holds, NULL otherwise."""
    return F.when(cond, key_concat(cols, sep))


def state_encode(cols: list[str], presence: bool = False, sep: str = "-") -> Column:
    """K3: encoded state string, values ('3-2') or occupancy flags ('1-0-1')."""
    parts = [F.col(c).isNotNull().cast("int").cast("string") if presence else _part(c) for c in cols]
    return F.concat_ws(sep, *parts)


def key_collision_audit(df: DataFrame, cols: list[str], sep: str = "") -> DataFrame:
    """K4: distinct tuples vs distinct concatenated keys; a difference means
    distinct tuples collapse onto one key (and K5 would then drop rows)."""
    return df.agg(F.count_distinct(F.struct(*cols)).alias("distinct_tuples"),
                  F.count_distinct(key_concat(cols, sep)).alias("distinct_keys")).withColumn(
        "collisions", F.col("distinct_tuples") - F.col("distinct_keys"))


def dedup_keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """K5: one row per key, the first by ``order`` (a total order)."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    ordering = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.min_by(packed, ordering).alias("__r")).select(*keys, *[F.col(f"__r.{c}") for c in rest])


def dedup_full(df: DataFrame) -> DataFrame:
    """K6: drop fully duplicate rows."""
    return df.distinct()


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def except_keys(new: DataFrame, existing: DataFrame, keys: list[str], null_safe: bool = True) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` (left anti join)."""
    ex = existing.select(*[F.col(k).alias(f"__e_{k}") for k in keys])
    cond = reduce(lambda a, b: a & b, [
        (new[k].eqNullSafe(ex[f"__e_{k}"]) if null_safe else new[k] == ex[f"__e_{k}"]) for k in keys])
    return new.join(ex, cond, "left_anti")


def mirror_rows(df: DataFrame, keep: list[str], perspectives: list[dict]) -> DataFrame:
    """One input row -> one output row per perspective.  Each perspective maps
    output column -> source column (or literal Column); one ``explode``, no union."""
    names = list(perspectives[0].keys())
    structs = [F.struct(*[(v if isinstance(v, Column) else F.col(v)).alias(n) for n, v in p.items()])
               for p in perspectives]
    return df.select(*keep, F.explode(F.array(*structs)).alias("__p")).select(*keep, *[F.col(f"__p.{n}") for n in names])
