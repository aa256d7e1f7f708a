"""Projections, renames, filters and derived columns.

All are narrow transformations (no shuffle) except ``distinct_dropna``;
filters are plain Catalyst predicates so they reach the Parquet scan."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Keep only the mapped columns, renamed (source -> target)."""
    return df.select(*[F.col(a).alias(b) for a, b in mapping.items()])


def normalize_header(name: str) -> str:
    """P2 rule: lower case; space and '/' -> '_'; '+' -> '_plus'; drop '?'."""
    n = name.lower().replace(" ", "_").replace("/", "_").replace("+", "_plus")
    return n.replace("?", "")


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename every column by the rule (metadata only, no data pass)."""
    return df.toDF(*[normalize_header(c) for c in df.columns])


def drop_cols_like(df: DataFrame, pattern: str = r"^Unnamed") -> DataFrame:
    """Drop columns whose name matches a regex."""
    rx = re.compile(pattern)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not rx.search(c)])


def filter_not_in(df: DataFrame, col: str, values: list, keep_null: bool = True) -> DataFrame:
    """NOT IN a literal list; ``keep_null`` keeps NULL rows (pandas ``~isin``)."""
    cond = ~F.col(col).isin(values)
    if keep_null:
        cond = cond | F.col(col).isNull()
    return df.filter(cond)


def filter_text_exclude(df: DataFrame, col: str, words: list[str], like: str | None = None,
                        like_col: str | None = None) -> DataFrame:
    """Optional LIKE on ``like_col``, then drop rows whose text contains any
    word (case-insensitive); a NULL text counts as "no match" and is kept."""
    out = df.filter(F.col(like_col or col).like(like)) if like else df
    for w in words:
        out = out.filter(~F.coalesce(F.lower(F.col(col)).contains(w.lower()), F.lit(False)))
    return out


def filter_known_dims(df: DataFrame, dim: DataFrame, dim_key: str, cols: list[str],
                      not_equal: tuple[str, str] | None = None) -> DataFrame:
    """P10: keep rows whose columns all appear in a dimension (one left-semi
    join per column) and, optionally, whose two columns differ (no tie)."""
    keys = dim.select(F.col(dim_key).alias("__k")).distinct()
    out = df
    for c in cols:
        out = out.join(keys, out[c] == keys["__k"], "left_semi")
    if not_equal:
        out = out.filter(F.col(not_equal[0]) != F.col(not_equal[1]))
    return out


def case_side(df: DataFrame, half_col: str, top_value: str, home_col: str, away_col: str,
              offense: str = "offense_team", defense: str = "defense_team") -> DataFrame:
    """Offense / defence team by inning half (top = away bats)."""
    top = F.col(half_col) == top_value
    return (df.withColumn(offense, F.when(top, F.col(away_col)).otherwise(F.col(home_col)))
              .withColumn(defense, F.when(top, F.col(home_col)).otherwise(F.col(away_col))))


def map_lookup(col: Column | str, mapping: dict, default=None) -> Column:
    """Literal map lookup with a default (``dict.get(k, default)``)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    c = F.col(col) if isinstance(col, str) else col
    v = m[c]
    return F.coalesce(v, F.lit(default)) if default is not None else v


def cast_columns(df: DataFrame, types: dict, safe: bool = True) -> DataFrame:
    """Cast a list of columns (``try_cast`` when ``safe``)."""
    return df.select(*[
        ((F.col(c).try_cast(types[c]) if safe else F.col(c).cast(types[c])).alias(c) if c in types else F.col(c))
        for c in df.columns])


def distinct_dropna(df: DataFrame, cols: list[str], subset: list[str] | None = None) -> DataFrame:
    """SELECT DISTINCT over a projection, dropping rows with NULL in ``subset``."""
    return df.select(*cols).na.drop(subset=subset or cols).distinct()


def all_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a & b, conds)
