"""Statistics and evaluation.

Many-column statistics run as one aggregation pass: predictors are unpivoted
into (name, x, y) rows and grouped by name, so the number of predictors only
changes the row count, not the number of scans."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diamondlake.functions.scalars import round_half_up


def unpivot(df: DataFrame, keep: list[str], cols: list[str], name: str = "feature",
            value: str = "x") -> DataFrame:
    """Wide → long: one row per (kept columns, feature)."""
    arr = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    return df.select(*keep, F.explode(arr).alias("__s")).select(*keep, f"__s.{name}", f"__s.{value}")


def gamma_half_ratio(a: Column) -> Column:
    """gamma(a + 1/2) / gamma(a) for a > 0: the asymptotic series at a + 32, and the recurrence back to a."""
    z = a + 32
    series = F.lit(1.0) - 1 / (8 * z) + 1 / (128 * z * z) + 5 / (1024 * z ** 3) - 21 / (32768 * z ** 4) - 399 / (262144 * z ** 5)
    back = F.aggregate(F.sequence(F.lit(0), F.lit(31)), F.lit(1.0), lambda acc, j: acc * (a + j) / (a + j + 0.5))
    return F.sqrt(z) * series * back


#: Terms of the series and of the continued fraction below; both have converged by then for any number of rows.
TERMS = 200


def beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, folded over its terms by the modified Lentz rule."""
    def off_zero(v: Column) -> Column:
        return F.when(F.abs(v) < 1e-300, F.lit(1e-300)).otherwise(v)

    def step(state: Column, k: Column) -> Column:
        m = F.floor(k / 2)
        term = F.when(k % 2 == 0, m * (b - m) * x / ((a + k - 1) * (a + k))).otherwise(-(a + m) * (a + b + m) * x / ((a + k - 1) * (a + k)))
        c, d = off_zero(1 + term / state.getField("c")), 1 / off_zero(1 + term * state.getField("d"))
        return F.struct(c.alias("c"), d.alias("d"), (state.getField("h") * c * d).alias("h"))

    first = 1 / off_zero(1 - (a + b) * x / (a + 1))
    return F.aggregate(F.sequence(F.lit(2), F.lit(TERMS)), F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h")), step, lambda s: s.getField("h"))


def beta_series(a: Column, b: Column, x: Column) -> Column:
    """Power series of the incomplete beta function over its front factor; all terms are positive."""
    def step(state: Column, k: Column) -> Column:
        term = state.getField("term") * (a + b + k) / (a + 1 + k) * x
        return F.struct(term.alias("term"), (state.getField("sum") + term).alias("sum"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(TERMS)), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")), step, lambda s: s.getField("sum"))


def correlation_p_value(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation (or of a simple regression's slope): Student's t with n - 2
    degrees of freedom, as the regularised incomplete beta function of 1 - r² at
    ((n - 2) / 2, 1/2). NULL for n <= 2 or without r; 0 at r = ±1.

    A small r² takes the series of the complement, whose length doesn't grow with n; any other the
    continued fraction, on the side where it converges quickly."""
    a, half = (n - 2) / 2.0, F.lit(0.5)
    r2 = F.least(r * r, F.lit(1.0))
    x = 1 - r2
    front = F.exp(a * F.log1p(-r2)) * F.sqrt(r2) * gamma_half_ratio(a) / math.sqrt(math.pi)
    series = 1 - front * beta_series(half, a, r2) / half
    upper = front * beta_fraction(a, half, x) / a
    lower = 1 - front * beta_fraction(half, a, r2) / half
    value = F.when((r2 < 0.3) & (a * r2 < 20), series).when(x < (a + 1) / (a + 2.5), upper).otherwise(lower)
    return F.when((n > 2) & r.isNotNull(), F.when(r2 == 1, F.lit(0.0)).otherwise(F.greatest(value, F.lit(0.0))))


def linregress_many(df: DataFrame, y: str, predictors: list[str], digits: int = 4, p_digits: int | None = None) -> DataFrame:
    """A10: simple linear regression y ~ x for every predictor in one pass:
    slope, intercept, r, slope standard error, n; with ``p_digits`` also the
    slope's two-sided ``p_value``."""
    long = unpivot(df.withColumn("__y", F.col(y).cast("double")), ["__y"], predictors, "predictor", "x")
    g = long.groupBy("predictor").agg(
        F.regr_slope("__y", "x").alias("slope"), F.regr_intercept("__y", "x").alias("intercept"),
        F.corr("x", "__y").alias("r"), F.regr_count("__y", "x").alias("n"),
        F.regr_sxx("__y", "x").alias("sxx"), F.regr_syy("__y", "x").alias("syy"))
    stderr = F.when((F.col("n") > 2) & (F.col("sxx") > 0), F.sqrt(
        (F.lit(1.0) - F.col("r") * F.col("r")) * F.col("syy") / F.col("sxx") / (F.col("n") - 2)))
    p_value = []
    if p_digits is not None:    # in a projection of its own: inside a lambda, the name r would mean the rounded r below
        g, p_value = g.withColumn("__p", correlation_p_value(F.col("r"), F.col("n"))), [round_half_up("__p", p_digits).alias("p_value")]
    return g.select("predictor", round_half_up("slope", digits).alias("slope"),
                    round_half_up("intercept", digits).alias("intercept"),
                    round_half_up("r", digits).alias("r"), round_half_up(stderr, digits).alias("stderr"), "n", *p_value)


def corr_matrix(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    """Pearson correlation of every pair of columns (long form, both orders and
    the diagonal) over the rows that have them all. One vector aggregation sums
    the cross products, so the number of columns adds no pass and no expression;
    its result is one matrix. A constant column gives NULL."""
    known = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    rows = VectorAssembler(inputCols=cols, outputCol="x").transform(known).select("x")     # read for the means, then the products
    spark = df.sparkSession
    schema = "feature_a string, feature_b string, corr double"
    if len(rows.take(2)) < 2:
        return spark.createDataFrame([(a, b, None) for a in cols for b in cols], schema)
    matrix = Correlation.corr(rows, "x").first()[0].toArray()
    cells = [(a, b, None if math.isnan(v) else float(v)) for a, line in zip(cols, matrix, strict=True) for b, v in zip(cols, line, strict=True)]
    return spark.createDataFrame(cells, schema).withColumn("corr", round_half_up("corr", digits))


def minmax_scale(df: DataFrame, cols: list[str], keep: list[str], digits: int = 4) -> DataFrame:
    """(x - min) / (max - min) per column; a constant column maps to 0.
    All minima and maxima come from one aggregation used as a scalar
    subquery (a one-row struct), so there is no join."""
    mm = df.agg(F.struct(*[F.min(c).alias(f"mn_{c}") for c in cols],
                         *[F.max(c).alias(f"mx_{c}") for c in cols]).alias("s")).scalar()
    scaled = []
    for c in cols:
        mn, mx = mm.getField(f"mn_{c}"), mm.getField(f"mx_{c}")
        scaled.append(F.when(mx == mn, F.lit(0.0)).otherwise(
            round_half_up((F.col(c) - mn) / (mx - mn), digits)).alias(c))
    return df.select(*keep, *scaled)


def classification_metrics(df: DataFrame, label: str, prediction: str, by: list[str] = (),
                           digits: int = 4) -> DataFrame:
    """Accuracy, precision, recall, F1 for 0/1 labels in one aggregation
    (a zero denominator gives 0, as the usual ``zero_division`` default)."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    g = df.groupBy(*by).agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                            F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    c = F.col

    def ratio(n, d):
        return F.when(d > 0, n.cast("double") / d).otherwise(F.lit(0.0))
    prec, rec = ratio(c("tp"), c("tp") + c("fp")), ratio(c("tp"), c("tp") + c("fn"))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return g.select(*by, "tp", "fp", "fn", "tn",
                    round_half_up(ratio(c("tp") + c("tn"), c("tp") + c("fp") + c("fn") + c("tn")), digits).alias("accuracy"),
                    round_half_up(prec, digits).alias("precision"), round_half_up(rec, digits).alias("recall"),
                    round_half_up(f1, digits).alias("f1"))


def regression_metrics(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """MAE, MSE and R² = 1 - SSE/SST in one pass."""
    e = F.col(label).cast("double") - F.col(prediction).cast("double")
    g = df.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.sum(e * e).alias("sse"),
               (F.var_pop(F.col(label).cast("double")) * F.count(F.col(label))).alias("sst"))
    return g.select(round_half_up("mae", digits).alias("mae"), round_half_up("mse", digits).alias("mse"),
                    round_half_up(F.lit(1.0) - F.try_divide(F.col("sse"), F.col("sst")), digits).alias("r2"))
