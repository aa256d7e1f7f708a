"""Hard negatives for anchors by a secondary-sort shuffle.

Scores are integer inner products of vectors. Anchors go over all rows in
blocks of bounded bytes. A first pass over the rows finds an anchor's
positives, its best rows of the same label. A second pass knows their score
windows, so each task keeps only what can be among the first negatives of a
window. These pairs get packed keys (anchor, descending score, kind, id), and
``repartitionAndSortWithinPartitions`` brings them into order. A streaming
iterator then opens a window at each positive and emits negatives until the
windows are full or passed; it holds an anchor's open windows and nothing
else of the anchor."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, prepare

#: Bytes of the anchor vectors that are broadcast at once.
BLOCK_BYTES = 16 << 20
#: Pairs that a task gathers before it keeps the best of each window.
GATHER = 1 << 19
LONG_MAX = (1 << 63) - 1


def _exact(x: float, scale: int) -> int:
    """floor(scale * x) without overflow."""
    return int(x) * scale if abs(x) >= 1 << 53 else math.floor(scale * x)


def quantize(flat: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): doubles as long as all are whole numbers a double holds, else Python integers."""
    small = flat.size == 0 or float(np.abs(flat).max()) * scale < 1 << 53
    return np.floor(flat * scale) if small else np.array([_exact(x, scale) for x in flat.tolist()], dtype=object)


def inner(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products (rows by anchors); 100 times a score stays exact too."""
    most = [float(max(abs(x.max()), abs(x.min()))) if x.size else 0.0 for x in (rows, anchors)]
    if object not in (rows.dtype, anchors.dtype) and most[0] * most[1] * max(1, rows.shape[1]) < 1 << 46:
        return np.rint(rows @ anchors.T)
    ints = [np.array([[int(v) for v in r] for r in x.tolist()], dtype=object).reshape(x.shape) for x in (rows, anchors)]
    return np.clip(ints[0] @ ints[1].T, -LONG_MAX, LONG_MAX) if rows.shape[1] else np.zeros((len(rows), len(anchors)))


class Block:
    """Some anchors: by number of components their numbers, ids, labels and vectors."""

    def __init__(self, rows: list[tuple], scale: int) -> None:
        self.ids = [r[0] for r in rows]
        self.scale, self.by_size = scale, {}
        for size in {len(r[2]) for r in rows}:
            nos = [k for k, r in enumerate(rows) if len(r[2]) == size]
            flat = quantize(np.array([x for k in nos for x in rows[k][2]], dtype=float), scale)
            self.by_size[size] = (np.array(nos), _column([rows[k][0] for k in nos]), _column([rows[k][1] for k in nos]), flat.reshape(len(nos), size))

    def scored(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """For each batch and size: anchor numbers, row ids, scores (rows by anchors), which pairs
        are other rows of the same label, and which have different labels."""
        for batch in batches:
            ids, labels, vecs = (batch.column(k) for k in range(3))
            sizes = np.array([len(v) for v in vecs], dtype=np.int64)
            ids, labels = (_column(c.to_pylist()) for c in (ids, labels))
            for size, (nos, own, label, matrix) in self.by_size.items():
                at = np.flatnonzero(sizes == size)
                if not len(at):
                    continue
                flat = vecs.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float)
                scores = inner(quantize(flat, self.scale).reshape(len(at), size), matrix)
                same = labels[at][:, None] == label[None, :]
                yield nos, ids[at], scores, same & (ids[at][:, None] != own[None, :]), ~same


def _column(values: list) -> np.ndarray:
    """Values as an array: numbers as such, anything else as objects."""
    if all(type(v) is int for v in values):
        return np.array(values, dtype=np.int64)
    out = np.empty(len(values), dtype=object)
    out[:] = values
    return out


class Best:
    """The first ``most`` pairs of each group, by descending score and ascending id; copies of a row count by themselves."""

    def __init__(self, groups: int, most: int) -> None:
        self.most, self.parts, self.held = most, [], 0
        self.least = np.full(groups, -math.inf, dtype=object)

    def bar(self, groups: np.ndarray, dtype: np.dtype) -> np.ndarray:
        """The score that a pair of each group must reach."""
        return self.least[groups].astype(dtype)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append((group, score, ids))
        self.held += len(group)
        if self.held >= GATHER:
            self.reduce()
            if self.held >= GATHER // 2:        # many groups: gather as much again before the next sort
                self.held = 0

    def reduce(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        group, score, ids = (np.concatenate([p[k] for p in self.parts]) if self.parts else np.array([], dtype=np.int64) for k in range(3))
        rank = np.empty(len(ids), dtype=np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        down = np.empty(len(ids), dtype=np.int64)
        down[np.argsort(-score, kind="stable")] = np.arange(len(ids))
        if len(ids):                            # equal scores get one place, so that the ids decide
            order = np.argsort(down)
            new = np.r_[False, score[order][1:] != score[order][:-1]]
            down[order] = np.cumsum(new)
        order = np.lexsort((rank, down, group.astype(np.int64)))
        group, score, ids = group[order], score[order], ids[order]
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.array([], dtype=np.int64)
        place = np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))
        keep = place < self.most
        last = keep & (place == self.most - 1)
        self.least[group[last].astype(np.int64)] = score[last]
        self.parts = [(group[keep], score[keep], ids[keep])]
        self.held = int(keep.sum())
        return self.parts[0]


def _positives(block: Block, most: int):
    """The best rows of the same label in one partition: (no, id, score)."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kind = Best(len(block.ids), most), []
        for nos, ids, scores, same, _ in block.scored(_typed(batches, kind)):
            r, a = np.nonzero(same & (scores >= best.bar(nos, scores.dtype)))
            best.add(nos[a], scores[r, a], ids[r])
        yield from _batches(best.reduce(), kind)
    return of


def _negatives(block: Block, windows: list[list[int]], most: int, low: int, high: int):
    """What can be among the first ``most`` rows of another label in a window: (no, id, score), once a row and anchor."""
    width = max((len(w) for w in windows), default=0)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kind = Best(len(windows) * max(1, width), most), []
        opened = np.array([[*w, *[-1] * (width - len(w))] for w in windows], dtype=object).reshape(len(windows), width)
        for nos, ids, scores, _, other in block.scored(_typed(batches, kind)):
            hundred = 100 * scores
            for k in range(width):
                lo, hi = ((x * opened[nos, k]).astype(scores.dtype) for x in (low, high))
                r, a = np.nonzero(other & (hundred >= lo) & (hundred <= hi) & (scores >= best.bar(nos * width + k, scores.dtype)))
                best.add(nos[a] * width + k, scores[r, a], ids[r])
        group, score, ids = best.reduce()
        rows = dict.fromkeys(zip((group // max(1, width)).tolist(), score.tolist(), ids.tolist(), _nth_copy(group, score, ids), strict=True))
        yield from _batches(tuple(_column([x[k] for x in rows]) for k in range(3)), kind)
    return of


def _nth_copy(group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> list[int]:
    """Number of each row among equal rows next to it: repeated rows of a window stay apart."""
    out, before, n = [], None, 0
    for x in zip(group.tolist(), score.tolist(), ids.tolist(), strict=True):
        n = n + 1 if x == before else 0
        before = x
        out.append(n)
    return out


def _typed(batches: Iterator[pa.RecordBatch], kind: list) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not kind:
            kind.append(b.schema.field(0).type)
        yield b


def _batches(rows: tuple[np.ndarray, np.ndarray, np.ndarray], kind: list) -> Iterator[pa.RecordBatch]:
    no, score, ids = (x.tolist() for x in rows)
    if no:
        yield pa.RecordBatch.from_arrays([pa.array(map(int, no), pa.int64()), pa.array(ids, kind[0]), pa.array([int(s) for s in score], pa.int64())], ["no", "id", "score"])


def stream(pairs: Iterator[tuple], negatives: int, low: int, high: int) -> Iterator[tuple]:
    """Rows (anchor, positive, rank, negative, positive score, negative score) from
    pairs in the order of their keys ((no, anchor), -score, kind, id); kind 0 is a
    positive, 1 a negative. Only the open windows of the present anchor are held."""
    anchor, windows = None, []
    for (key, down, kind, row), _ in pairs:
        if key != anchor:
            anchor, windows = key, []
        score = -down
        if kind == 0:
            windows.append([score, row, 0])
            continue
        windows = [w for w in windows if w[2] < negatives and low * w[0] <= 100 * score]
        for w in windows:
            if 100 * score <= high * w[0]:
                w[2] += 1
                yield key[1], w[1], w[2], row, w[0], score


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | Column = "label", positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90, scale: int = 256, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each anchor (rows of ``vectors`` where ``is_anchor``) and each of its
    first ``positives`` other rows of the same label, the first ``negatives`` rows of
    another label with low * positive <= 100 * score <= high * positive: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of floor(scale * component); higher ones come
    first, then smaller ids. Scores beyond a long stop at its ends. Rows without
    id or label, without vector, or with a null or non-finite component take no
    part, nor do pairs of vectors of different length with each other. Rows with
    the anchor's id aren't other rows; an anchor that stands in several equal rows
    counts once, other repeated rows each take a place. Anchors without positives
    or negatives give no row, and an empty table none. Ids and labels may have any
    type that Spark and Python order alike; extra columns take no part."""
    spark = prepare(vectors.sparkSession)
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    a, = fresh(vectors, "anchor")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), label.alias("label"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias(a))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & fine)
    anchors, rows = rows.where(F.col(a)).drop(a).distinct(), rows.drop(a)
    id_type = rows.schema["id"].dataType.simpleString()
    pair = f"no long, id {id_type}, score long"
    out = f"anchor_id {id_type}, positive_id {id_type}, rank int, negative_id {id_type}, positive_score long, negative_score long"
    total = anchors.agg(F.sum(F.size("vec") * 8 + 64)).first()[0] or 0
    blocks = -(-total // block_bytes)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = []
    for k in range(blocks):
        held = anchors.where(F.pmod(F.xxhash64("id", "label"), F.lit(blocks)) == k).collect()      # about block_bytes
        if not held:
            continue
        block = Block(held, scale)
        first = Window.partitionBy("no").orderBy(F.desc("score"), "id")
        found = rows.mapInArrow(_positives(block, positives), pair).withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
        opened = [(r["no"], r["id"], r["score"]) for r in found.collect()]                          # a few for each anchor of the block
        windows = [[] for _ in held]
        for no, _, score in opened:
            windows[no].append(score)
        keys = [((k, no), x, s) for no, x, s in opened]
        names = block.ids
        keyed.append(spark.sparkContext.parallelize(keys, 1).map(lambda x, names=names: (((x[0], names[x[0][1]]), -x[2], 0, x[1]), None)))
        near = rows.mapInArrow(_negatives(block, windows, negatives, low, high), pair)
        keyed.append(near.rdd.map(lambda r, k=k, names=names: ((((k, r[0]), names[r[0]]), -r[2], 1, r[1]), None)))
    if not keyed:
        return spark.createDataFrame([], out)
    ordered = spark.sparkContext.union(keyed).repartitionAndSortWithinPartitions(parts, lambda key: key[0][0][0] * 1_000_003 + key[0][0][1])
    return spark.createDataFrame(ordered.mapPartitions(lambda pairs: stream(pairs, negatives, low, high)), out)
