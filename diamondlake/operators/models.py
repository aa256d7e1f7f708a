"""Model operators on MLlib (M1-M5, M8).

Fitting runs as distributed aggregations inside MLlib (normal-equation
statistics / tree histograms via treeAggregate); scoring is a
``transform``, i.e. a projection over the partitions."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def complete(cols: list[str]) -> Column:
    """Whether a row has a value in each of ``cols``."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in cols])


def assemble(df: DataFrame, cols: list[str], out: str = "features", handle_invalid: str = "keep") -> DataFrame:
    """M1: feature vector from named columns.  By default every row stays, missing
    inputs are NaN in the vector; fit on the rows that are ``complete``."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def features_array(df: DataFrame, col: str = "features") -> DataFrame:
    return df.withColumn(col, vector_to_array(F.col(col)))


def fit_ridge_classifier(df: DataFrame, label: str, features: str = "features", alpha: float = 1.0):
    """M2: ridge classifier = ridge regression on labels mapped to -1/+1,
    prediction = sign.  sklearn's penalty ``alpha·||w||²`` on the raw squared
    error maps to MLlib's ``regParam = alpha·std(y)/n`` with
    ``standardization=False`` (MLlib scales the label by its std internally)."""
    y = (F.col(label).cast("double") * 2.0 - 1.0)
    data = df.withColumn("__y", y)
    return ridge(data, "__y", alpha, features).fit(data)


def ridge(data: DataFrame, label: str, alpha: float = 1.0, features: str = "features") -> LinearRegression:
    """Ridge regression of ``label`` (its penalty needs the number and deviation of the labels)."""
    stats = data.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("sd")).first()
    reg = alpha * float(stats["sd"] or 0.0) / max(int(stats["n"]), 1)
    return LinearRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=0.0,
                            standardization=False, solver="normal", predictionCol="score")


def predict_sign(model, df: DataFrame, out: str = "predicted") -> DataFrame:
    """Score and threshold at 0 (RidgeClassifier decision rule)."""
    return model.transform(df).withColumn(out, (F.col("score") > 0).cast("int"))


def fit_ols(df: DataFrame, label: str, features: str = "features", prediction: str = "prediction"):
    """M3: ordinary least squares (normal equations, no penalty)."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, solver="normal",
                            predictionCol=prediction).fit(df)


def fit_game_models(train: DataFrame, cols: list[str], win: str, runs: str, alpha: float = 1.0) -> PipelineModel:
    """One pipeline that assembles ``cols`` and carries both game models: the ridge
    classifier of the win (column ``score``) and the OLS model of the runs
    (``runs_score``). Rows that lack a value are left out of the fit."""
    data = train.where(complete(cols)).withColumn("__y", F.col(win).cast("double") * 2.0 - 1.0).withColumn("__r", F.col(runs).cast("double"))
    win_model, runs_model = ridge(data, "__y", alpha), LinearRegression(featuresCol="features", labelCol="__r", regParam=0.0, solver="normal", predictionCol="runs_score")
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep"), win_model, runs_model]).fit(data)


def save_model(model, path: str) -> str:
    """M8: persist to the shared store."""
    model.write().overwrite().save(path)
    return path


def load_linear_model(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)
