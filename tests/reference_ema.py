"""Reference implementations of the exponential average used only to
cross-check ``diamondlake.operators.scan.ema_scan`` on small inputs: a JVM
``aggregate`` fold over each entity's collected rows (O(n^2)) and a grouped
pandas function (whole group in memory).  Neither belongs in a job on large
groups, which is why they live in the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from diamondlake.functions.scalars import round_half_up


def ema_columns(df: DataFrame, entity: str, order_col: str, cols: list[str], span: int = 28,
                suffix: str = "_ema") -> DataFrame:
    """Exponential moving average, ``alpha = 2/(span+1)``, ``adjust=False``
    (pandas ``ewm``), per entity over rows ordered by ``order_col``.

    One sorted array per entity (an entity is one row per game/day, bounded by
    the schedule) folded with ``aggregate`` into the EMA sequence, JVM-side.
    NULL inputs follow pandas (``ignore_na=False``): the state keeps
    ``k`` = steps since the last value and the next value gets weight
    alpha against (1-alpha)^k for the old mean."""
    alpha = 2.0 / (span + 1.0)
    packed = F.struct(F.col(order_col).alias("o"), *[F.col(c).cast("double").alias(c) for c in cols])
    g = df.groupBy(entity).agg(F.array_sort(F.collect_list(packed)).alias("__seq"))
    outs = []
    for c in cols:
        init = F.struct(F.array().cast(f"array<double>").alias("out"),
                        F.lit(None).cast("double").alias("y"), F.lit(0).alias("k"))
        fold = F.aggregate(
            F.col("__seq"), init,
            lambda acc, x: F.struct(
                F.concat(acc["out"], F.array(
                    F.when(x[c].isNull(), acc["y"])
                     .when(acc["y"].isNull(), x[c])
                     .otherwise((F.pow(F.lit(1 - alpha), acc["k"] + 1) * acc["y"] + F.lit(alpha) * x[c])
                                / (F.pow(F.lit(1 - alpha), acc["k"] + 1) + F.lit(alpha))))).alias("out"),
                F.when(x[c].isNull(), acc["y"]).when(acc["y"].isNull(), x[c]).otherwise(
                    (F.pow(F.lit(1 - alpha), acc["k"] + 1) * acc["y"] + F.lit(alpha) * x[c])
                    / (F.pow(F.lit(1 - alpha), acc["k"] + 1) + F.lit(alpha))).alias("y"),
                F.when(x[c].isNull() & acc["y"].isNotNull(), acc["k"] + 1).otherwise(F.lit(0)).alias("k")),
            lambda acc: acc["out"])
        outs.append(fold.alias(f"__e_{c}"))
    g = g.select(entity, "__seq", *outs)
    z = g.select(entity, F.posexplode("__seq").alias("__i", "__row"),
                 *[F.col(f"__e_{c}") for c in cols])
    return z.select(entity, F.col("__row.o").alias(order_col),
                    *[F.col(f"__row.{c}").alias(c) for c in cols],
                    *[F.element_at(F.col(f"__e_{c}"), F.col("__i") + 1).alias(c + suffix) for c in cols])



def ema_pandas(df: DataFrame, entity: str, order: list[str], cols: list[str], span: int = 28,
               suffix: str = "_ema", digits: int | None = 4) -> DataFrame:
    """Pandas ``ewm(span, adjust=False).mean()`` per entity in ``order``
    (NaN handling exactly as pandas)."""
    keep = [entity] + [c for c in order if c != entity]
    src = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    fields = [f for f in src.schema.fields] + [StructField(c + suffix, DoubleType()) for c in cols]
    schema = StructType(fields)

    def run(pdf):
        pdf = pdf.sort_values(order, kind="mergesort")
        for c in cols:
            pdf[c + suffix] = pdf[c].ewm(span=span, adjust=False).mean()
        return pdf

    out = src.groupBy(entity).applyInPandas(run, schema)
    if digits is not None:
        for c in cols:
            out = out.withColumn(c + suffix, round_half_up(c + suffix, digits))
    return out


