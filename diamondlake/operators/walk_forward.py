"""Rolling-origin evaluation (M7): each row is scored by the ridge model of all
earlier days, without a fit per day.

A ridge model needs only sums of products. These are taken once per day (partial
sums per task, so a hot day is no hot task) and summed up over the days; every
day's model then is one small linear system. The tables of sums and models have
one entry per day and pair of features, bounded by the calendar, not by the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diamondlake.functions.scalars import round_half_up
from diamondlake.operators.models import complete


def ridge_of_sums(sums: np.ndarray, alpha: float) -> np.ndarray | None:
    """Intercept and weights from the matrix of sums of products of (1, features, label); the intercept isn't
    penalised. None without a row."""
    n = sums[0, 0]
    if n < 1:
        return None
    mean = sums[0] / n
    centred = sums - n * np.outer(mean, mean)
    k = len(sums) - 2
    w = np.linalg.solve(centred[1:k + 1, 1:k + 1] + alpha * np.eye(k), centred[1:k + 1, k + 1])
    return np.r_[mean[k + 1] - mean[1:k + 1] @ w, w]


def daily_sums(df: DataFrame, day: str, features: list[str], label: Column) -> DataFrame:
    """(day, i, v): per day the sums of products of (1, features, label), i numbering the pairs. Rows that lack a
    value or a day are left out."""
    known = df.where(complete(features) & F.col(day).isNotNull()).select(F.col(day).alias("day"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], label.cast("double").alias("y"))
    upper = np.triu_indices(len(features) + 2)
    kind = dict(df.dtypes)[day]

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict = {}
        for pdf in batches:
            code, days = pd.factorize(pdf["day"])
            order = np.argsort(code, kind="stable")
            x = np.column_stack([np.ones(len(pdf)), pdf.drop(columns="day").to_numpy(float)])[order]
            ends = np.cumsum(np.bincount(code, minlength=len(days)))
            for at, low, high in zip(days, np.r_[0, ends], ends):
                total[at] = total.get(at, 0.0) + (x[low:high].T @ x[low:high])[upper]
        for at, sums in total.items():
            yield pd.DataFrame({"day": [at], "sums": [sums]})

    parts = known.where("y IS NOT NULL").mapInPandas(part, f"day {kind}, sums array<double>")
    return parts.select("day", F.posexplode("sums").alias("i", "v")).groupBy("day", "i").agg(F.sum("v").alias("v"))


def models_by_day(df: DataFrame, day: str, features: list[str], label: Column, alpha: float = 1.0) -> DataFrame:
    """(day, model): for each day of ``df`` intercept and weights of the ridge model of all earlier days; NULL
    where no earlier row is complete."""
    sums = daily_sums(df, day, features, label)
    days = df.where(F.col(day).isNotNull()).select(F.col(day).alias("day")).distinct()
    k = len(features) + 2
    cells = days.select("day", F.explode(F.sequence(F.lit(0), F.lit(k * (k + 1) // 2 - 1))).alias("i")).join(sums, ["day", "i"], "left")
    earlier = Window.partitionBy("i").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)      # one row per day
    upto = cells.select("day", "i", F.coalesce(F.sum("v").over(earlier), F.lit(0.0)).alias("v"))
    per_day = upto.groupBy("day").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("cells"))
    upper = np.triu_indices(k)

    @F.pandas_udf("array<double>")
    def solve(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = []
            for v in s:
                m = np.zeros((k, k))
                m[upper] = v
                out.append(ridge_of_sums(m + np.triu(m, 1).T, alpha))
            yield pd.Series(out, dtype=object)

    return per_day.select("day", solve(F.transform("cells", lambda c: c.getField("v"))).alias("model"))


def walk_forward(df: DataFrame, day: str, features: list[str], label: Column, alpha: float = 1.0, out: str = "score") -> DataFrame:
    """``df`` with the score of the model of the days before its own. NULL on the first day, without a day and
    where a feature is missing; no row is lost."""
    models = models_by_day(df, day, features, label, alpha).withColumnsRenamed({"day": "__day", "model": "__model"})
    terms = [F.col("__model").getItem(i + 1) * F.col(c) for i, c in enumerate(features)]
    score = sum(terms[1:], terms[0]) + F.col("__model").getItem(0)
    joined = df.join(F.broadcast(models), F.col(day) == F.col("__day"), "left")      # one row per day
    return joined.withColumn(out, F.when(complete(features), score)).drop("__day", "__model")


def backtest_games(scored: DataFrame, game: str, day: str, home: str, won: str, score: str = "score", digits: int = 9) -> DataFrame:
    """One row per game from its two perspectives: both scores, whether home was predicted to win (NULL without
    both scores or at a tie), whether it did, and whether the prediction was right. Scores equal to ``digits``
    places are a tie: what is left between them is the rounding of sums, which another order of the rows changes."""
    at_home = F.col(home).cast("boolean")
    g = scored.groupBy(game, day).agg(F.max(F.when(at_home, F.col(score))).alias("home_score"), F.max(F.when(~at_home, F.col(score))).alias("away_score"),
                                      F.max(F.when(at_home, F.col(won).cast("boolean"))).alias("home_won"))
    home_score, away_score = round_half_up("home_score", digits), round_half_up("away_score", digits)
    ahead = F.when(home_score != away_score, home_score > away_score)
    return g.withColumn("predicted", ahead).withColumn("correct", F.col("predicted") == F.col("home_won"))
