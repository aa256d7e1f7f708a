"""Join operators.

Broadcast policy: ``broadcast_bounded`` is only applied to sides whose row
count is bounded by construction (one row per season, per nation, per event
type, a one-row scalar).  Sides that grow with the data are joined without a
hint so the planner's size estimate and AQE's runtime statistics decide between
broadcast-hash and sort-merge; AQE's skew-join handling splits hot keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def broadcast_bounded(df: DataFrame) -> DataFrame:
    """Mark a side whose size is bounded by construction for broadcast."""
    return F.broadcast(df)


def join_chain(fact: DataFrame, *steps) -> DataFrame:
    """Chain of equi-joins; each step is ``(dim, on, how)``."""
    out = fact
    for dim, on, how in steps:
        out = out.join(dim, on=on, how=how)
    return out


def join_latest_row(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                    rank_col: str = "rn") -> DataFrame:
    """LEFT JOIN with an extra predicate on the right side (``rn = 1``);
    the predicate is applied below the join so it prunes before the shuffle."""
    r = right.filter(F.col(rank_col) == 1).drop(rank_col)
    return left.join(r, left[left_key] == r[right_key], "left")


def join_on_expression(left: DataFrame, right: DataFrame, left_expr: Column, right_col: str,
                       how: str = "left") -> DataFrame:
    """Join on a computed key (e.g. ``season = year(date)``)."""
    return left.join(right, left_expr == right[right_col], how)


def normalize_key(c: Column) -> Column:
    """trim + lower for text keys."""
    return F.lower(F.trim(c))


def join_anti_normalized(new: DataFrame, existing: DataFrame, keys: list[str],
                         text_keys: list[str] = ()) -> DataFrame:
    """Rows of ``new`` whose (normalised, typed) key is absent from
    ``existing``.  NULL keys compare equal (``<=>``) as pandas merge does."""
    ex = existing.select(*[
        (normalize_key(F.col(k)) if k in text_keys else F.col(k)).alias(f"__k{i}")
        for i, k in enumerate(keys)]).distinct()
    cond = reduce(lambda a, b: a & b, [
        (normalize_key(new[k]) if k in text_keys else new[k]).eqNullSafe(ex[f"__k{i}"])
        for i, k in enumerate(keys)])
    return new.join(ex, cond, "left_anti")


def join_full_coalesce(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                       key_name: str, left_val: str, right_val: str, total_name: str) -> DataFrame:
    """FULL OUTER JOIN of two keyed aggregates, coalescing key and counts."""
    j = left.join(right, left[left_key] == right[right_key], "full_outer")
    return j.select(
        F.coalesce(left[left_key], right[right_key]).alias(key_name),
        (F.coalesce(left[left_val], F.lit(0)) + F.coalesce(right[right_val], F.lit(0))).alias(total_name))


def join_semi(df: DataFrame, known: DataFrame, key: str, known_key: str) -> DataFrame:
    """Membership test (team in known set)."""
    return df.join(known.select(F.col(known_key).alias(key)).distinct(), key, "left_semi")


def join_matchup(games: DataFrame, features: DataFrame, game_key: str, home_col: str, away_col: str,
                 team_col: str, date_col: str | None, home_prefix: str = "home_",
                 away_prefix: str = "away_") -> DataFrame:
    """Attach one feature row per side of a game (home ⊕ away), prefixing
    the feature columns.  Two equi-joins on (team[, date])."""
    feats = [c for c in features.columns if c not in (team_col, date_col)]
    keys = [team_col] + ([date_col] if date_col else [])

    def side(prefix, team_expr_col):
        f = features.select(*[F.col(k).alias(f"__{prefix}{k}") for k in keys],
                            *[F.col(c).alias(prefix + c) for c in feats])
        cond = games[team_expr_col] == f[f"__{prefix}{team_col}"]
        if date_col:
            cond = cond & (games[date_col] == f[f"__{prefix}{date_col}"])
        return f, cond

    hf, hc = side(home_prefix, home_col)
    out = games.join(hf, hc, "inner")
    af, _ = side(away_prefix, away_col)
    ac = out[away_col] == af[f"__{away_prefix}{team_col}"]
    if date_col:
        ac = ac & (out[date_col] == af[f"__{away_prefix}{date_col}"])
    out = out.join(af, ac, "inner")
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def join_double_anti(candidates: DataFrame, dim_a: DataFrame, dim_b: DataFrame, key: str,
                     a_key: str, b_key: str, rename: dict | None = None) -> DataFrame:
    """Keys of ``candidates`` missing from both dims (chained anti joins)."""
    out = candidates.join(dim_a.select(F.col(a_key).alias(key)), key, "left_anti")
    out = out.join(dim_b.select(F.col(b_key).alias(key)), key, "left_anti")
    for a, b in (rename or {}).items():
        out = out.withColumnRenamed(a, b)
    return out
