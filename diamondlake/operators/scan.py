"""Skew-safe ordered scan for the exponential moving average (W6), and exact quantiles by selection.

An EMA is a left-to-right recurrence per entity.  Running it per entity (a
window or a grouped pandas function) puts a hot entity in one task.  This
operator is a two-pass parallel prefix scan instead:

1. ``repartitionByRange`` on (entity, order...) cuts the globally sorted rows
   into balanced partitions, so a hot entity is spread over many partitions.
   Each partition is read in chunks of about ``CHUNK_ROWS`` rows, so a task's memory
   doesn't grow with its rows. A chunk runs the recurrence locally (vectorised
   pandas) and expresses every output as an affine function of the unknown
   state carried in from earlier chunks: ``y = y0 + r*(y1 - x)`` where ``y0`` is
   the average from the chunk's own rows, ``x`` the segment's first observation
   and ``y1`` the average after it.
2. Only the first and last entity segment of each chunk can continue
   across a boundary, so at most two summary rows per chunk are resolved
   (grouped by entity, at most one row per chunk each) into carry-in states,
   which are broadcast (two per ``CHUNK_ROWS`` rows) and applied with
   column expressions.

NULL inputs follow pandas ``ewm(adjust=False, ignore_na=False)``: a gap of g
missing values before an observation x makes the update
``y = (w*y + alpha*x) / (w + alpha)`` with ``w = (1-alpha)^(g+1)``, and
missing positions repeat the last average.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from diamondlake.functions.scalars import round_half_up
from diamondlake.operators.nullsafe import join_null_safe
from diamondlake.session import store

#: Rows that a task of the scan holds at a time.
CHUNK_ROWS = 20_000


def _range_partition(df: DataFrame, keys: list[str], num_partitions: int | None) -> DataFrame:
    """Range partitioning on the full sort key.  Without an explicit count the
    shuffle uses ``spark.sql.shuffle.partitions`` and AQE may merge adjacent
    small ranges; merged partitions stay contiguous and in key order, which is
    all the scans rely on."""
    return df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)


def _local_fields(c: str) -> list[StructField]:
    return [StructField(f"__y0_{c}", DoubleType()), StructField(f"__r_{c}", DoubleType()),
            StructField(f"__pre_{c}", BooleanType()),
            # summary-only fields
            StructField(f"__xf_{c}", DoubleType()), StructField(f"__gf_{c}", LongType()),
            StructField(f"__has_{c}", BooleanType()), StructField(f"__kt_{c}", LongType())]


def _chunks(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The batches in order, joined up to ``rows`` rows or just over."""
    held, n = [], 0
    for b in batches:
        if len(b):
            held.append(b)
            n += len(b)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def ema_scan(df: DataFrame, entity: str, order: list[str], cols: list[str], span: int = 28,
             suffix: str = "_ema", digits: int | None = 4, num_partitions: int | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    alpha = 1.0 / (1.0 + (span - 1) / 2.0)     # pandas: com = (span - 1) / 2, alpha = 1 / (1 + com)
    a = 1.0 - alpha
    keep = [entity] + [c for c in order if c != entity]
    src = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    ordered = (_range_partition(src, keep, num_partitions).sortWithinPartitions(*keep)
               .withColumn("__pid", F.spark_partition_id().cast("long")))
    base_fields = [StructField(f.name, f.dataType, True) for f in ordered.schema.fields]  # summary rows leave them NULL
    out_schema = StructType(base_fields + [StructField("__kind", StringType()), StructField("__nrows", LongType())]
                            + [f for c in cols for f in _local_fields(c)])
    names = [f.name for f in out_schema.fields]

    def local(batches):
        for number, pdf in enumerate(_chunks(batches, chunk_rows)):
            pdf["__pid"] = pdf["__pid"] * (1 << 32) + number      # chunks of all partitions in the order of their rows
            yield from scanned(pdf)

    def scanned(pdf):
        n = len(pdf)
        codes = pdf.groupby([entity], dropna=False, sort=False).ngroup().to_numpy()   # NULL keys: one group
        start = np.ones(n, dtype=bool)
        start[1:] = codes[1:] != codes[:-1]
        seg = np.cumsum(start) - 1
        nseg = int(seg[-1]) + 1
        pos = np.arange(n)
        seg_lo = np.flatnonzero(start)
        seg_hi = np.r_[seg_lo[1:], n]
        out = pdf.copy()
        out["__kind"] = "row"
        out["__nrows"] = None
        summ = {}
        for c in cols:
            x = pdf[c].to_numpy(dtype="float64")
            obs = ~np.isnan(x)
            # local recurrence of every segment, vectorised across segments
            y0 = (pd.Series(x).groupby(seg).ewm(span=span, adjust=False).mean()
                  .reset_index(level=0, drop=True).sort_index().to_numpy())
            cnt = pd.Series(obs.astype(np.int64)).groupby(seg).cumsum().to_numpy()
            obs_pos = pd.Series(np.where(obs, pos, np.nan))
            prev = obs_pos.groupby(seg).shift(1).groupby(seg).ffill().to_numpy()
            gap = pos - prev - 1
            later_obs = obs & (cnt > 1)
            fac = np.ones(n)
            wg = a ** (gap[later_obs] + 1)
            fac[later_obs] = wg / (wg + alpha)
            r = pd.Series(fac).groupby(seg).cumprod().to_numpy()
            first_obs = obs & (cnt == 1)
            xf = pd.Series(np.where(first_obs, x, np.nan)).groupby(seg).transform("max").to_numpy()
            gf_row = pd.Series(np.where(first_obs, pos, np.nan)).groupby(seg).transform("max").to_numpy()
            gf = gf_row - seg_lo[seg]
            pre = cnt == 0
            r = np.where(pre, np.nan, r)
            out[f"__y0_{c}"] = y0
            out[f"__r_{c}"] = r
            out[f"__pre_{c}"] = pre
            for f in ("xf", "gf", "has", "kt"):
                out[f"__{f}_{c}"] = None
            for k in {0, nseg - 1}:
                lo, hi = seg_lo[k], seg_hi[k]
                last = hi - 1
                has = bool(obs[lo:hi].any())
                kt = int((hi - 1) - np.flatnonzero(obs[lo:hi])[-1] - lo) if has else int(hi - lo)
                summ.setdefault(k, {})[c] = dict(has=has, r=r[last], y0=y0[last], kt=kt,
                                                 xf=xf[lo], gf=int(0 if np.isnan(gf[lo]) else gf[lo]))
        yield out[names]
        rows = []
        for k, per in summ.items():
            lo, hi = seg_lo[k], seg_hi[k]
            row = {nm: None for nm in names}
            row.update({entity: pdf[entity].iloc[lo], "__pid": int(pdf["__pid"].iloc[lo]), "__kind": "sum",
                        "__nrows": int(hi - lo)})
            for c, v in per.items():
                row.update({f"__{f}_{c}": x for f, x in v.items()})
            rows.append(row)
        sdf = pd.DataFrame(rows, columns=names)
        for f in out_schema.fields:
            if isinstance(f.dataType, LongType):
                sdf[f.name] = sdf[f.name].astype("Int64")
        yield sdf

    local_df = ordered.mapInPandas(local, out_schema)
    # materialise once: the row fix-up and the edge summaries must see the same chunks
    local_df = store(local_df)

    summaries = local_df.filter(F.col("__kind") == "sum").select(
        entity, "__pid", "__nrows", *[F.col(f"__{f}_{c}") for c in cols for f in ("has", "r", "y0", "kt", "xf", "gf")])
    carry_fields = [StructField(entity, ordered.schema[entity].dataType, True),
                    StructField("__pid", ordered.schema["__pid"].dataType, True)]
    for c in cols:
        carry_fields += [StructField(f"__din_{c}", BooleanType()), StructField(f"__yin_{c}", DoubleType()),
                         StructField(f"__shift_{c}", DoubleType())]
    carry_schema = StructType(carry_fields)

    def resolve(pdf):
        pdf = pdf.sort_values("__pid", kind="mergesort")
        res = {entity: pdf[entity].tolist(), "__pid": pdf["__pid"].tolist()}
        for c in cols:
            d, y, k = False, np.nan, 0
            dl, yl, sl = [], [], []
            for _, row in pdf.iterrows():   # at most one row per chunk of this entity
                dl.append(d); yl.append(y if d else np.nan); sl.append(np.nan)
                if not row[f"__has_{c}"]:
                    k = k + int(row["__nrows"]) if d else 0
                    continue
                if d:
                    w = a ** (k + int(row[f"__gf_{c}"]) + 1)
                    sl[-1] = w * (y - row[f"__xf_{c}"]) / (w + alpha)
                    y = row[f"__y0_{c}"] + row[f"__r_{c}"] * sl[-1]
                else:
                    y = row[f"__y0_{c}"]
                d, k = True, int(row[f"__kt_{c}"])
            res[f"__din_{c}"], res[f"__yin_{c}"], res[f"__shift_{c}"] = dl, yl, sl
        return pd.DataFrame(res)

    carry = summaries.groupBy(entity).applyInPandas(resolve, carry_schema)
    rows = local_df.filter(F.col("__kind") == "row")
    carry = carry.withColumnRenamed(entity, "__ce").withColumnRenamed("__pid", "__cp")
    j = rows.join(F.broadcast(carry), rows[entity].eqNullSafe(carry["__ce"]) & (rows["__pid"] == carry["__cp"]),
                  "left")   # <= 2 rows per chunk; NULL entities are one group, as in a window
    outs = []
    for c in cols:
        din = F.coalesce(F.col(f"__din_{c}"), F.lit(False))
        y = (F.when(F.col(f"__pre_{c}"), F.when(din, F.col(f"__yin_{c}")))
             .when(~din, F.col(f"__y0_{c}"))
             .otherwise(F.col(f"__y0_{c}") + F.col(f"__r_{c}") * F.col(f"__shift_{c}")))
        outs.append((round_half_up(y, digits) if digits is not None else y).alias(c + suffix))
    return j.select(*keep, *cols, *outs)


#: Accuracy of the sketch that bounds a quantile's value range, the ranks added on both sides as
#: a share of the group (four times the sketch's error), and the size up to which every value is counted.
ACCURACY = 10_000
MARGIN, SMALL = 4 / ACCURACY, 2 * ACCURACY


def quantile_edges(value: str, probs: list[float]) -> Column:
    """Aggregate: for each quantile two values that have it between them (lower, upper, lower, ...)."""
    shares = [min(max(p + side * MARGIN, 0.0), 1.0) for p in probs for side in (-1, 1)]
    return F.percentile_approx(value, shares, ACCURACY)


def select_quantiles(vals: DataFrame, edges: DataFrame, group: str, value: str, probs: list[float], carry: list[str] = ()) -> DataFrame:
    """Exact quantiles by selection: ``edges`` has one row per group with its number of values ``__n`` and
    ``quantile_edges`` ``__edges``, besides columns to ``carry`` along. Of the values only those between the edges of a quantile are
    counted one by one (under a thousandth of a large group, besides ties); the others are
    counted per gap. Running sums over these counts give the value at a rank. Returns one row
    per group, the quantiles as an array ``__q`` in the order of ``probs`` (of NULLs for a group of NULL values alone)."""
    v, n = F.col(value), F.col("__n")
    ends = [F.col("__edges").getItem(i) for i in range(2 * len(probs))]
    wanted = reduce(lambda a, b: a | b, [v.between(lo, hi) for lo, hi in zip(ends[::2], ends[1::2], strict=True)], n <= SMALL)
    gap = reduce(lambda a, b: a + b, [(v > e).cast("int") for e in ends])
    placed = join_null_safe(vals, edges.select(group, "__n", "__edges", *carry), [group])
    cells = placed.select(group, "__n", *carry, gap.alias("__gap"), F.when(wanted, v).alias("__v"), v.isNotNull().cast("long").alias("__one"))
    cells = cells.groupBy(group, "__n", *carry, "__gap", "__v").agg(F.sum("__one").alias("__c"))
    # Inside a gap the values that aren't counted one by one are smaller than those that are: nulls first.
    w = Window.partitionBy(group).orderBy("__gap", F.col("__v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("__upto", F.sum("__c").over(w)).withColumn("__before", F.col("__upto") - F.col("__c"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("__before") < rank) & (rank <= F.col("__upto")), F.col("__v")))
    spots = [(n - 1) * F.lit(float(p)) for p in probs]
    found = cells.groupBy(group, "__n", *carry).agg(*[c for i, h in enumerate(spots) for c in (
        at(F.floor(h) + 1).alias(f"__lo{i}"), at(F.least(F.floor(h) + 2, n)).alias(f"__hi{i}"))])

    def known(c: str) -> Column:
        return F.when(F.col(c).isNull() & (n > 0), F.raise_error("a quantile lies outside its range").cast("double")).otherwise(F.col(c))
    return found.select(group, *carry, F.array(*[known(f"__lo{i}") + (known(f"__hi{i}") - known(f"__lo{i}")) * (h - F.floor(h)) for i, h in enumerate(spots)]).alias("__q"))


def exact_quantiles(long_df: DataFrame, group: str, value: str, probs: list[float],
                    num_partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (pandas / ``quantile_cont``) per group in two passes over the
    values, without a sort or a ranking of all of them: a sketch bounds each quantile's range, then
    ``select_quantiles`` counts inside the ranges. NULL values don't count, NULL is a group; without
    values a group has no row. ``num_partitions`` deals the values anew first.

    Returns (group, p, q)."""
    vals = long_df.select(group, value).filter(F.col(value).isNotNull())
    vals = vals.repartition(num_partitions) if num_partitions else vals
    edges = vals.groupBy(group).agg(F.count(F.lit(1)).alias("__n"), quantile_edges(value, probs).alias("__edges"))
    found = select_quantiles(vals, edges, group, value, probs)
    pairs = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.col("__q").getItem(i).alias("q")) for i, p in enumerate(probs)])
    return found.select(group, F.explode(pairs).alias("__s")).select(group, "__s.p", "__s.q")
