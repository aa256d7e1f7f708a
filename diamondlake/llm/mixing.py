"""Mixing sources to target weights by cube-method balanced sampling.

Every document gets the inclusion number target / size of its source: the whole
part is taken for certain, the fraction is drawn. The cube method draws all
fractions of a source together: a vector in the null-space of the balancing
constraints (document and token totals) moves the fractions until one reaches 0
or 1, which keeps both totals exactly; this goes on until no more fractions are
free than there are constraints. Those, and a dozen documents of the source that don't fly, land
on the roundings that come nearest to the totals.

A source of any size is cut into blocks of bounded size by a hash; each block
flies by itself, its last undecided documents go to blocks of a
next level, and so on, until one block per source is left to land. A hot source
is thus many small groups, and each level leaves a thousandth of the rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, fresh, id_key, word_count

WEIGHTS, CAP = (1, 2, 3), 3
#: Documents of one flight, on average.
BLOCK = 2048
#: Documents of a source that its last flight leaves to the landing, besides the two it can't decide.
LANDING = 12
EPS = 1e-9


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sources`` (source, source_size: one row each) with ``src`` (position by
    code point from 0, null last), ``weight`` and ``target``.

    Targets share the total size by weight, at most ``cap`` times the source's
    own size; what is over is shared again by weight. Sources fill up in the
    order of size per weight, so the set that is full is a prefix of it and
    running sums give the level of the rest. One row per source goes through
    one task."""
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int")).cast("double")
    df = sources.withColumn("src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("weight", w)
    everything, order = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy(F.col("source_size") / F.col("weight"), "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("source_size").cast("double")
    left = F.sum(size).over(everything) - cap * F.coalesce(F.sum(size).over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # The level if all before this source are full; the true one is the first that does not fill its own source.
    df = df.withColumn("level", left / weight_left).withColumn("fills", cap * size <= F.col("level") * F.col("weight"))
    level = F.first(F.when(~F.col("fills"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    df = df.withColumn("at", level)
    target = F.when(F.col("at").isNull() | (cap * size <= F.col("at") * F.col("weight")), cap * size).otherwise(F.col("at") * F.col("weight"))
    return df.select("source", "source_size", "src", "weight", target.alias("target"))


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves the fractions ``p`` through the null-space of (1, size), keeping
    sum(p) and sum(p * size), until at most two of them lie strictly between 0
    and 1. Each step works on three free documents and decides one at least."""
    p = p.copy()
    free: list[int] = []
    for k in range(len(p)):
        if EPS < p[k] < 1 - EPS:
            free.append(k)
        while len(free) == 3:
            a, b, c = free
            u = np.array([size[b] - size[c], size[c] - size[a], size[a] - size[b]], dtype=float)
            if not u.any():
                u = np.array([1.0, -1.0, 0.0])
            q = p[free]
            moves = u != 0
            room_up = np.where(u[moves] > 0, 1 - q[moves], q[moves]) / np.abs(u[moves])
            room_down = np.where(u[moves] > 0, q[moves], 1 - q[moves]) / np.abs(u[moves])
            up, down = room_up.min(), room_down.min()
            q = q + up * u if rng.random() * (up + down) < down else q - down * u
            p[free] = np.clip(np.where(q < EPS, 0.0, np.where(q > 1 - EPS, 1.0, q)), 0.0, 1.0)
            free = [i for i in free if EPS < p[i] < 1 - EPS]
    return p


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rounds the open fractions (a few) to the 0/1 choices whose token total,
    in mean sizes, and document total together are nearest to theirs."""
    open_ = np.nonzero((p > EPS) & (p < 1 - EPS))[0]
    out = np.rint(p)
    if len(open_):
        choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_)) & 1).astype(float)
        off = choices - p[open_]
        cost = np.abs(off @ size[open_]) / max(size.mean(), 1.0) + 0.05 * np.abs(off.sum(axis=1))
        out[open_] = choices[int(cost.argmin())]
    return out


def fly(pdf: pd.DataFrame) -> pd.DataFrame:
    """Flight of one block's rows, and their landing if it is its source's only block."""
    pdf = pdf.sort_values(["mark", "th", "occ"], kind="stable", ignore_index=True)
    rng = np.random.default_rng([int(pdf[c].iloc[0]) for c in ("src", "block", "level")])
    size, p = pdf["size"].to_numpy(float), pdf["p"].to_numpy(float)
    land = bool(pdf["land"].iloc[0])
    kept = LANDING if land else 0  # these stay for the landing
    p[kept:] = flight(p[kept:], size[kept:], rng)
    return pdf.drop(columns="land").assign(p=landing(p, size) if land else p)


def _balanced(units: DataFrame, block: int) -> DataFrame:
    """(id0, no_id, th, occ, drawn) for units with a fraction ``p``."""
    keys = ["src", "size", "mark", "id0", "no_id", "th", "occ"]
    schema = "src long, size long, mark long, id0 long, no_id boolean, th long, occ int, p double, block long, level int"
    open_, level, done = units.select(*keys, "p"), 0, None
    while True:
        counts = open_.groupBy("src").agg(F.count("*").alias("n_src"))
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n_src") / block)).cast("long")
        # No sums to keep between levels but the blocks' own: each block's flight keeps its totals exactly.
        spread = open_.join(counts, "src").withColumn("block", F.pmod(F.xxhash64("mark", "th", F.lit(level)), blocks)).withColumn("level", F.lit(level))
        # A source lands in the level in which it has one block, whatever the others still do.
        spread = spread.withColumn("land", blocks == 1)
        last = (counts.agg(F.max("n_src")).first()[0] or 0) <= block
        # Dealt anew: Spark would take the join's exchange on src for grouped enough, and put a hot source into one task.
        flown = spread.select(*keys, "p", "block", "level", "land").repartition("src", "block").groupBy("src", "block").applyInPandas(fly, schema)
        flown = checkpoint(flown.select(*keys, "p"))
        decided = flown.where((F.col("p") <= EPS) | (F.col("p") >= 1 - EPS))
        done = decided if done is None else done.unionByName(decided)
        if last:
            break
        open_, level = flown.where((F.col("p") > EPS) & (F.col("p") < 1 - EPS)), level + 1
    return done.select("id0", "no_id", "th", "occ", (F.col("p") >= 0.5).cast("int").alias("drawn"))


def _row_keys(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [id_key(docs, id_col).alias("id0"), F.col(id_col).isNull().alias("no_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(source_col), F.lit("\0"))).alias("th")]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: the id, row keys, size, source_size,
    target and ``copies`` (how often the mix takes the document).

    Null texts have size 0 and null sources form one source, the last. Rows
    that are repeated (same id, text and source) are numbered by ``occ`` and drawn
    each. Documents without words are drawn like others of their source and
    weigh nothing; a source without words is not taken. An empty table gives no
    rows. Draws depend on ids and texts only, so reruns agree."""
    occ = F.row_number().over(Window.partitionBy("id0", "no_id", "th").orderBy(F.lit(0)))
    rows = docs.select(F.col(id_col).alias("id"), *_row_keys(docs, id_col, text_col, source_col), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    rows = checkpoint(rows.withColumn("occ", occ))
    sizes = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    pi = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = rows.alias("r").join(sizes.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))).select("r.id", "id0", "no_id", "th", "occ", "size", F.col("r.source").alias("source"), "source_size", F.col("src").cast("long").alias("src"), "target", pi.alias("pi"))
    whole = F.floor(F.col("pi") + EPS)
    units = checkpoint(units.withColumn("whole", whole.cast("int")).withColumn("p", F.greatest(F.col("pi") - whole, F.lit(0.0))).withColumn("mark", F.xxhash64("id0", "no_id")))
    key = ["id0", "no_id", "th", "occ"]
    drawn = _balanced(units.where(F.col("p") > EPS), block)
    out = units.join(drawn, key, "left")
    return out.select("id", *key, "size", "source", "source_size", "target", (F.col("whole") + F.coalesce("drawn", F.lit(0))).alias("copies"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken, others
    gone. All columns are kept, whatever their names."""
    names = dict(zip(("id0", "no_id", "th", "occ", "copies", "again"), fresh(docs, "id0", "no_id", "th", "occ", "copies", "again"), strict=True))
    taken = mix(docs, id_col, text_col, source_col, **options).where("copies > 0").select(*(F.col(k).alias(names[k]) for k in ("id0", "no_id", "th", "occ", "copies")))
    key = [names[k] for k in ("id0", "no_id", "th")]
    keyed = docs.select("*", *(c.alias(n) for c, n in zip(_row_keys(docs, id_col, text_col, source_col), key, strict=True)))
    keyed = keyed.withColumn(names["occ"], F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0))))
    out = keyed.join(taken, [*key, names["occ"]]).withColumn(names["again"], F.explode(F.sequence(F.lit(1), F.col(names["copies"]))))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
