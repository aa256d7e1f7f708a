"""Aggregations.

All of these aggregate partially on the map side, so a hot group key costs
one partial row per input partition, not a skewed task.  ``min_by``/``max_by``
over structs are planned as sort aggregates, the rest as hash aggregates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diamondlake.functions.scalars import round_half_up
from diamondlake.operators.nullsafe import join_null_safe
from diamondlake.operators.scan import quantile_edges, select_quantiles

NOT_NULL = object()  # category spec: "any non-NULL value" (num_pa in the leaderboards)


def category_predicate(col: str, spec) -> Column:
    if isinstance(spec, Column):
        return spec
    if spec is NOT_NULL:
        return F.col(col).isNotNull()
    values = list(spec)
    return F.col(col).isin(values) if values else F.lit(False)


def conditional_counts(df: DataFrame, by: list[str], category_col: str, categories: dict) -> DataFrame:
    """A1: ``SUM(CASE WHEN c IN (...) THEN 1 ELSE 0 END)`` per category, one pass."""
    aggs = [F.count_if(category_predicate(category_col, spec)).alias(name)
            for name, spec in categories.items()]
    return df.groupBy(*by).agg(*aggs)


def all_categories_present(df: DataFrame, by: list[str], category_col: str, categories: dict) -> DataFrame:
    """A2: per group counts, keep groups where every category occurred (HAVING)."""
    counts = conditional_counts(df, by, category_col, categories)
    return counts.filter(reduce(lambda a, b: a & b, [F.col(n) > 0 for n in categories]))


def sum_max(df: DataFrame, by: list[str], sums: dict, maxes: dict) -> DataFrame:
    """A3: SUM of several columns and MAX of others per group."""
    aggs = [F.sum(c).alias(a) for a, c in sums.items()] + [F.max(c).alias(a) for a, c in maxes.items()]
    return df.groupBy(*by).agg(*aggs)


def counts_two_roles(home: DataFrame, home_col: str, away: DataFrame, away_col: str,
                     team_name: str = "team") -> DataFrame:
    """A4 + J6 in one shuffle: per team, rows in the home role and in the away
    role.  Unioning the tagged roles and aggregating once replaces two
    group-bys and a full outer join."""
    tagged = (home.select(F.col(home_col).alias(team_name), F.lit(1).alias("__h"), F.lit(0).alias("__a"))
              .unionByName(away.select(F.col(away_col).alias(team_name), F.lit(0).alias("__h"), F.lit(1).alias("__a"))))
    return tagged.groupBy(team_name).agg(
        F.sum("__h").cast("bigint").alias("home_games"),
        F.sum("__a").cast("bigint").alias("away_games"),
        F.count(F.lit(1)).alias("total_games"))


def scalar_min(df: DataFrame, col: str, alias: str) -> DataFrame:
    """A5: one-row global MIN."""
    return df.agg(F.min(col).alias(alias))


def value_counts(df: DataFrame, col: str, value_name: str | None = None, count_name: str = "count") -> DataFrame:
    """Frequency of each value, renamed."""
    return df.groupBy(F.col(col).alias(value_name or col)).agg(F.count(F.lit(1)).alias(count_name))


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column NULL count and number of distinct non-NULL values, long form."""
    cols = cols or df.columns
    aggs = []
    for c in cols:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n__{c}"), F.count_distinct(F.col(c)).alias(f"d__{c}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `n__{c}`, `d__{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, null_count, distinct_count)")


def describe_columns(df: DataFrame, cols: list[str], exact: bool = True, digits: int = 4) -> DataFrame:
    """count/mean/std/min/25%/50%/75%/max per column (pandas ``describe``).

    Columns are unpivoted to (column_name, v) rows.  The first aggregation gives
    the moments and a sketch's range of each quartile, the second counts the
    values inside these ranges (``select_quantiles``), so quartiles are exact
    without ranking the values; ``exact=False`` takes ``percentile_approx``."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s")
    ).select("s.*")
    r = lambda e: round_half_up(e, digits)
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    moments = [F.count("v").alias("count"), r(F.avg("v")).alias("mean"), r(F.stddev_samp("v")).alias("std"),
               F.min("v").alias("min"), F.max("v").alias("max")]
    if not exact:
        return long.groupBy("column_name").agg(*moments, *[r(F.percentile_approx("v", p, 10000)).alias(k)
                                                           for k, p in probs.items()]).select(
            "column_name", "count", "mean", "std", "min", *probs, "max")
    m = long.groupBy("column_name").agg(*moments, quantile_edges("v", list(probs.values())).alias("__edges"))
    m = F.broadcast(m.withColumn("__n", F.col("count")))       # one row per described column
    q = select_quantiles(long, m, "column_name", "v", list(probs.values()), ["count", "mean", "std", "min", "max"])
    return q.select("column_name", "count", "mean", "std", "min", *[r(F.col("__q").getItem(i)).alias(k) for i, k in enumerate(probs)], "max")


def _ratio(num: Column, den: Column, digits: int) -> Column:
    """P12 guarded division: NULL when the denominator is not positive."""
    return F.when(den > 0, round_half_up(num.cast("double") / den.cast("double"), digits))


def rate_stats(df: DataFrame, hits="hit_count", at_bats="total_ab", on_base="num_obp", walks="walks",
               sac_flies="sf", singles="num_singles", doubles="num_doubles", triples="num_triples",
               home_runs="num_hrs", extra_walks: str | None = "ibb", digits: int = 4) -> DataFrame:
    """BA, OBP, SLG, OPS from counting columns (formulas as written,
    intentional walks added to both OBP terms when ``extra_walks`` is given)."""
    c = F.col
    tb = c(singles) + 2 * c(doubles) + 3 * c(triples) + 4 * c(home_runs)
    ob_num = c(on_base) + (c(extra_walks) if extra_walks else F.lit(0))
    ob_den = c(at_bats) + c(walks) + c(sac_flies) + (c(extra_walks) if extra_walks else F.lit(0))
    out = (df.withColumn("slg", _ratio(tb, c(at_bats), digits))
             .withColumn("ba", _ratio(c(hits), c(at_bats), digits))
             .withColumn("obp", _ratio(ob_num, ob_den, digits)))
    return out.withColumn("ops", round_half_up(c("obp") + c("slg"), digits))


def weighted_rate(df: DataFrame, weights: DataFrame, season_expr: Column, weight_season_col: str,
                  terms: dict, denominator: Column, out_col: str = "woba", digits: int = 3) -> DataFrame:
    """Σ wᵢ·countᵢ / denominator with weights looked up per season.
    ``weights`` has one row per season (bounded) → broadcast."""
    w = F.broadcast(weights)
    j = df.join(w, season_expr == w[weight_season_col], "left")
    num = reduce(lambda a, b: a + b, [F.col(wc) * F.col(cc) for wc, cc in terms.items()])
    out = j.withColumn(out_col, F.when(denominator > 0, round_half_up(num / denominator.cast("double"), digits)))
    return out.drop(*[c for c in weights.columns])


def majority_vote(trials: DataFrame, game_col: str, home_col: str, away_col: str) -> DataFrame:
    """Per game, home wins if it won more trials than the away side."""
    return trials.groupBy(game_col).agg(
        F.count_if(F.col(home_col) > F.col(away_col)).alias("home_wins"),
        F.count_if(F.col(away_col) > F.col(home_col)).alias("away_wins"),
    ).withColumn("home_predicted_win", F.col("home_wins") > F.col("away_wins"))


def transition_probs(df: DataFrame, entity: str, state: str, event: str, next_state: str,
                     runs: str, digits: int = 4) -> DataFrame:
    """Empirical P(event, next state | entity, state) and mean runs.
    One pass over the plays; the per-state totals are re-aggregated from the
    (much smaller) transition counts and joined back."""
    cnt = df.groupBy(entity, state, event, next_state).agg(
        F.count(F.lit(1)).alias("n"), F.avg(runs).alias("avg_runs"))
    tot = cnt.groupBy(entity, state).agg(F.sum("n").alias("n_state"))
    j = join_null_safe(cnt, tot, [entity, state])
    return j.select(entity, state, event, next_state, "n",
                    round_half_up(F.col("n") / F.col("n_state"), digits).alias("prob"),
                    round_half_up("avg_runs", digits).alias("avg_runs"))
