"""Forecast of many team statistics to the day of a game (M5, M6).

All targets share one random forest: a statistic's next value is learned from
its present value, its exponential average and the statistic itself as a
categorical input, in units of its standard deviation. Training rows are in
long form, one per (team day, statistic), so the fit makes one pass over the
data per tree level whatever the number of targets. Rows are then rolled
forward day by day with frozen averages, each by its own number of days."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from diamondlake.operators.scan import ema_scan


def wide_form(df: DataFrame, keep: list[str], targets: list[str], value: str = "value") -> DataFrame:
    """One column per statistic from rows (``keep``, target, value)."""
    return df.groupBy(*keep).agg(*[F.max(F.when(F.col("target") == float(k), F.col(value))).alias(c) for k, c in enumerate(targets)])


def scales(long: DataFrame) -> DataFrame:
    """Mean and standard deviation of each statistic (one row per statistic)."""
    return long.groupBy("target").agg(F.coalesce(F.avg("value"), F.lit(0.0)).alias("mean"), F.coalesce(F.nullif(F.stddev_pop("value"), F.lit(0.0)), F.lit(1.0)).alias("sd"))


def ema_by_day(states: DataFrame, team: str, day: str, targets: list[str], span: int = 28) -> DataFrame:
    """``states`` (one row per team and day) in long form, with the exponential
    average of each statistic and its value on the team's next day: value, ema,
    following. A window holds one team's days, so the calendar bounds it."""
    ema = ema_scan(states.select(team, day, *targets), team, [day], targets, span=span, digits=None)
    days = Window.partitionBy(team).orderBy(day)
    ema = ema.select("*", *[F.lead(c).over(days).alias(f"{c}__next") for c in targets])
    items = F.array(*[F.struct(F.lit(float(k)).alias("target"), F.col(c).cast("double").alias("value"), F.col(f"{c}_ema").alias("ema"),
                               F.col(f"{c}__next").cast("double").alias("following")) for k, c in enumerate(targets)])
    return ema.select(team, day, F.explode(items).alias("i")).select(team, day, "i.*").where("value IS NOT NULL")


def fit(train: DataFrame, unit: DataFrame, num_trees: int = 100, max_depth: int = 5, seed: int = 42, statistics: int = 36) -> RandomForestRegressionModel:
    """One forest for all statistics; ``train`` has target, value, ema, following, ``unit`` their scales."""
    data = _scaled(train.where("following IS NOT NULL"), unit).withColumn("label", (F.col("following") - F.col("mean")) / F.col("sd"))
    return RandomForestRegressor(featuresCol="x", labelCol="label", predictionCol="next", numTrees=num_trees, maxDepth=max_depth,
                                 seed=seed, maxBins=max(64, statistics)).fit(data)


def _scaled(df: DataFrame, unit: DataFrame) -> DataFrame:
    scaled = df.join(F.broadcast(unit), "target")         # one row per statistic
    scaled = scaled.withColumns({"v": (F.col("value") - F.col("mean")) / F.col("sd"), "e": (F.col("ema") - F.col("mean")) / F.col("sd")})
    return VectorAssembler(inputCols=["target", "v", "e"], outputCol="x").transform(scaled)


def tree_nodes(model: RandomForestRegressionModel, path: str) -> list[np.ndarray]:
    """Each tree's nodes as rows (feature or -1, threshold, left, right, prediction), read
    from the saved model; the number of trees and their depth bound them."""
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    node = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    cells = node.select("treeID", "id", "split.featureIndex", F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"), "leftChild", "rightChild", "prediction")
    trees: dict[int, dict[int, tuple]] = {}
    for r in cells.collect():
        inner = r["leftChild"] >= 0
        trees.setdefault(r["treeID"], {})[r["id"]] = (r["featureIndex"] if inner else -1, r["threshold"] if inner else 0.0, r["leftChild"], r["rightChild"], r["prediction"])
    return [np.array([tree[k] for k in sorted(tree)], dtype=float) for _, tree in sorted(trees.items())]


def predict(trees: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """The forest's mean prediction for the rows of ``x``."""
    total = np.zeros(len(x))
    for tree in trees:
        at = np.zeros(len(x), dtype=int)
        while True:
            feature = tree[at, 0].astype(int)
            inner = feature >= 0
            if not inner.any():
                break
            left = x[np.arange(len(x)), np.maximum(feature, 0)] <= tree[at, 1]
            at = np.where(inner, np.where(left, tree[at, 2], tree[at, 3]).astype(int), at)
        total += tree[at, 4]
    return total / max(len(trees), 1)


def roll_forward(model: RandomForestRegressionModel, unit: DataFrame, state: DataFrame, path: str) -> DataFrame:
    """``state`` (target, value, ema, ahead and any keys) with each value moved on day by
    day by its row's ``ahead`` days; a row that has arrived stays as it is. The
    days of all rows pass inside one task per partition; ``path`` holds the model."""
    trees, names = tree_nodes(model, path), state.columns

    def moved(batches):
        for b in batches:
            value, mean, sd = (b[c].to_numpy(dtype=float).copy() for c in ("value", "mean", "sd"))
            ahead, average = b["ahead"].to_numpy(), (b["ema"].to_numpy(dtype=float) - mean) / sd
            for day in range(1, int(ahead.max(initial=0)) + 1):
                on = np.flatnonzero(ahead >= day)
                x = np.column_stack([b["target"].to_numpy()[on], (value[on] - mean[on]) / sd[on], average[on]])
                value[on] = predict(trees, x) * sd[on] + mean[on]
            yield b.assign(value=value)[names]
    return state.join(F.broadcast(unit), "target").mapInPandas(moved, state.schema)        # one row per statistic


def latest(history: DataFrame, team: str, day: str) -> DataFrame:
    """Each team's last value and average of each statistic, and the team's last day."""
    return history.groupBy(team, "target").agg(F.max_by("value", day).alias("value"), F.max_by("ema", day).alias("ema"), F.max(day).alias(day))
