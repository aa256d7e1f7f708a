"""Quality by positive-unlabelled learning.

Trusted positives are the training documents labelled good; every document of the
corpus is unlabelled web text. A linear model over shape features of the whole text
minimises the non-negative unbiased risk

    prior * E_pos[loss(+)] + max(0, E_all[loss(-)] - prior * E_pos[loss(-)])

by Newton steps that stay where the second term is not negative. Features are
worked out once and written to the shared checkpoint folder; each step is one Spark
aggregation over all documents, of which a fixed number of sums reaches the
driver. The class prior is estimated from positives and unlabelled documents alone
(``estimate_prior``); a last link, which moves no document past another, fits the
logits to a bounded sample of training labels (``SAMPLE`` per class)."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, is_training

#: Ridge; a pass must lower the risk by more than this, or the search goes on with shorter steps and ends at the shortest.
RIDGE, TOL, ROUGH, SHORTEST = 1e-3, 1e-5, 1e-3, 1e-4
#: Step lengths that a pass tries, and the parts of the bad part that a direction along the constraint keeps.
FRACTIONS, KEPT = (1.0, 0.5, 0.25, 0.1), (0.5, 0.1)
#: Score bins of the prior's estimate.
BINS = 1000
SAMPLE = 4000
PRIOR_RANGE = (0.05, 0.95)
THRESHOLD = 0.5

UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
LETTER = re.compile(r"[^\W\d_]")
SYMBOLS = "#*$%&|<>{}[]=+~^\\@_/"
NAMES = ("symbol_words", "symbols", "pipes", "bangs", "capitals", "all_capitals", "top_word", "repeated_pair", "few_distinct", "letters", "digits", "short_words", "long_words", "same_lines", "length", "few_words", "no_stop", "urls", "any_symbol", "any_pipe")


def features(text: str | None) -> list[float]:
    """Shape of a whole text, each value from 0 to 1; null counts as empty."""
    t = text or ""
    words, lines = t.split(), [x for x in t.split("\n") if x.strip()]
    n, chars = max(len(words), 1), max(len(t), 1)
    symbols = {c: k for c in SYMBOLS if (k := t.count(c))}
    n_symbols, pipes, bangs = sum(symbols.values()), symbols.get("|", 0), t.count("!")
    n_upper, n_letters = len(UPPER.findall(t)), len(LETTER.findall(t))
    count = Counter(words)
    top = max(count.values(), default=0)
    pairs = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lengths = [len(w) for w in words]
    marked = sum(k for w, k in count.items() if w[-1] in SYMBOLS)
    cap = lambda x, at: min(x / at, 1.0)
    return [
        cap(marked / n, 0.5), cap(n_symbols / n, 1.0), cap(pipes / n, 0.3), cap(bangs / n, 0.5), cap(n_upper / max(n_letters, 1), 0.5),
        float(n_upper > 0.6 * n_letters and n_letters > 5), cap(max(top / n - 0.08, 0), 0.3) if n > 8 else 0.0, cap(pairs / n, 0.2), cap(1 - len(count) / n, 1.0) if n > 20 else 0.0,
        n_letters / chars, cap(sum(map(t.count, "0123456789")) / chars, 0.2), sum(x < 3 for x in lengths) / n, sum(x > 14 for x in lengths) / n,
        1 - len(set(lines)) / max(len(lines), 1), cap(math.log1p(len(t)), 12.0), float(len(words) < 10), 1.0 if n > 30 and max(lengths, default=0) < 4 else 0.0,
        cap(t.count("://") / n, 0.05), float(n_symbols > 2), float(pipes > 2),
    ]


@dataclass(frozen=True)
class Model:
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    link: tuple[float, float]
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w = np.array(self.weights)
        return (x - np.array(self.mean)) / np.array(self.scale) @ w[1:] + w[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.link[0] + self.link[1] * self.logits(x)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def with_features(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str) -> DataFrame:
    """(id, x, y) per document, checkpointed: y is the label of a training row, else null. Only ids and features are shuffled."""
    @F.pandas_udf("array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([features(t) for t in s], dtype=object)

    rows = docs.select(F.col(id_col).alias("id"), of(F.col(text_col)).alias("x"))
    y = labels.where(F.col(id_col).isNotNull() & is_training(F.col(id_col)) & F.col(label).isin(0, 1))
    y = y.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y"))
    return checkpoint(rows.join(y, "id", "left"))


def train(rows: DataFrame) -> Model:
    """Model from ``with_features``. Without positives: every text scores the middle of the prior's range."""
    d = len(NAMES)
    one = rows.agg(F.count("*").alias("n"), F.sum("y").alias("pos"),
                   *(F.avg(F.get("x", F.lit(i))).alias(f"m{i}") for i in range(d)), *(F.stddev_pop(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(d))).first()
    n, pos = one["n"], one["pos"] or 0
    mean = np.array([one[f"m{i}"] or 0.0 for i in range(d)])
    scale = np.array([max(one[f"s{i}"] or 0.0, 0.02) for i in range(d)])
    if not pos:
        return Model(tuple(mean), tuple(scale), (0.0,) * (d + 1), (0.0, 1.0), 0.5)

    def at(ws: list[np.ndarray]) -> list[Sums]:
        return _sums(rows, ws, mean, scale)

    # A first model at an even prior ranks the documents; the prior is read off that ranking.
    first = minimise(at, start(d + 1, 0.5), n, pos, 0.5, ROUGH)
    prior = estimate_prior(*_histograms(rows, first, mean, scale))
    w = minimise(at, start(d + 1, prior), n, pos, prior, TOL)
    model = Model(tuple(mean), tuple(scale), tuple(w), (0.0, 1.0), prior)
    return Model(model.mean, model.scale, model.weights, _link(rows, model), prior)


@dataclass(frozen=True)
class Sums:
    """Sums over documents at some weights: losses as bad of all and of the
    positives, their gradients, features of the positives, curvature of the first."""

    bad_all: float
    bad_pos: float
    grad_all: np.ndarray
    grad_pos: np.ndarray
    x_pos: np.ndarray
    hess_all: np.ndarray

    @staticmethod
    def of(x: np.ndarray, positive: np.ndarray, w: np.ndarray) -> Sums:
        z = x @ w
        p, loss = 1 / (1 + np.exp(-np.clip(z, -30, 30))), np.logaddexp(0, z)
        return Sums(loss.sum(), loss[positive].sum(), x.T @ p, x[positive].T @ p[positive], x[positive].sum(axis=0), (x * (p * (1 - p))[:, None]).T @ x)

    def flat(self) -> np.ndarray:
        return np.concatenate([[self.bad_all, self.bad_pos], self.grad_all, self.grad_pos, self.x_pos, self.hess_all.ravel()])

    @staticmethod
    def of_flat(v: np.ndarray, k: int) -> Sums:
        return Sums(v[0], v[1], v[2:2 + k], v[2 + k:2 + 2 * k], v[2 + 2 * k:2 + 3 * k], v[2 + 3 * k:].reshape(k, k))

    def bad_part(self, n: float, pos: float, prior: float) -> float:
        """Estimated risk of the bad class, which must not fall below zero."""
        return self.bad_all / n - prior * self.bad_pos / pos

    def risk(self, w: np.ndarray, n: float, pos: float, prior: float) -> float:
        """Non-negative risk and ridge; with the logistic loss, loss(+) is loss(-) less the logit."""
        good_part = prior * (self.bad_pos - self.x_pos @ w) / pos
        return good_part + max(0.0, self.bad_part(n, pos, prior)) + RIDGE / 2 * float(w[1:] @ w[1:])


def start(k: int, prior: float) -> np.ndarray:
    """The constant model of a prior; its bad part is positive."""
    return np.r_[math.log(prior / (1 - prior)), np.zeros(k - 1)]


def directions(w: np.ndarray, s: Sums, n: float, pos: float, prior: float) -> list[np.ndarray]:
    """The Newton direction of the risk where the bad part is positive (there it
    is convex), and, if that direction would end below zero, the nearest one
    in the metric of the curvature that keeps a part of the bad part."""
    ridge = np.r_[0, np.full(len(w) - 1, RIDGE)]
    hess = s.hess_all / n + np.diag(ridge + 1e-6)
    newton = -np.linalg.solve(hess, s.grad_all / n - prior * s.x_pos / pos + ridge * w)
    bad, slope = s.bad_part(n, pos, prior), s.grad_all / n - prior * s.grad_pos / pos
    out = [newton]
    if bad + slope @ newton < 0:
        lift = np.linalg.solve(hess, slope)
        out += [newton + lift * (keep * bad - bad - slope @ newton) / max(slope @ lift, 1e-12) for keep in KEPT]
    return out


def minimise(at: Callable[[list[np.ndarray]], list[Sums]], w: np.ndarray, n: float, pos: float, prior: float, tol: float) -> np.ndarray:
    """Weights of least non-negative risk among those whose bad part is not
    negative, from the feasible ``w``. Each pass tries several lengths along
    ``directions`` and moves only to feasible weights of a lower risk; it ends
    when no length down to ``SHORTEST`` lowers the risk by more than ``tol``."""
    (s,) = at([w])
    risk, length = s.risk(w, n, pos, prior), 1.0
    while length >= SHORTEST:
        tried = [w + length * f * d for d in directions(w, s, n, pos, prior) for f in FRACTIONS]
        sums = at(tried)
        found = [(t.risk(v, n, pos, prior), i) for i, (v, t) in enumerate(zip(tried, sums, strict=True)) if t.bad_part(n, pos, prior) >= 0]
        best, i = min(found, default=(risk, -1))
        if best < risk - tol:
            w, s, risk, length = tried[i], sums[i], best, 1.0
        else:
            length *= FRACTIONS[-1] / 2
    return w


def estimate_prior(every: np.ndarray, good: np.ndarray) -> float:
    """Share of good documents, from counts of all documents and of trusted
    positives by score (ascending bins). If the top of the ranking holds good
    ones only, its share of all documents over its share of the positives is
    the prior; of all tops, the one with the least upper bound is taken, the
    bound allowing for what chance does to the two shares."""
    n, m = every.sum(), good.sum()
    q_all, q_good = every[::-1].cumsum() / n, good[::-1].cumsum() / m
    chance = math.sqrt(math.log(40) / 2 / n) + math.sqrt(math.log(40) / 2 / m)
    some = q_good > 0
    best = int(np.argmin(np.where(some, (q_all + chance) / np.where(some, q_good, 1.0), np.inf)))
    return float(min(max(q_all[best] / q_good[best], PRIOR_RANGE[0]), PRIOR_RANGE[1]))


def _design(pdf: pd.DataFrame, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(pdf)), (np.stack(pdf["x"].to_numpy()) - mean) / scale])


def _summed(rows: DataFrame, size: int, of: Callable[[pd.DataFrame], np.ndarray]) -> np.ndarray:
    """Sum over all rows of a fixed number of values: a partial sum a task, one row a value to the driver."""
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for pdf in batches:
            if len(pdf):
                total += of(pdf)
        yield pd.DataFrame({"i": range(size), "v": total})

    found = dict(rows.select("x", "y").mapInPandas(part, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect())
    return np.array([found.get(i, 0.0) for i in range(size)])


def _sums(rows: DataFrame, ws: list[np.ndarray], mean: np.ndarray, scale: np.ndarray) -> list[Sums]:
    """Sums at each of some weights, in one pass."""
    k = len(ws[0])

    def of(pdf: pd.DataFrame) -> np.ndarray:
        x, positive = _design(pdf, mean, scale), pdf["y"].to_numpy(float) == 1
        return np.concatenate([Sums.of(x, positive, w).flat() for w in ws])

    size = 2 + 3 * k + k * k
    return [Sums.of_flat(v, k) for v in _summed(rows, size * len(ws), of).reshape(len(ws), size)]


def _histograms(rows: DataFrame, w: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all documents and of the positives by score, in ``BINS`` equal bins."""
    def of(pdf: pd.DataFrame) -> np.ndarray:
        bin_ = np.minimum(BINS / (1 + np.exp(-np.clip(_design(pdf, mean, scale) @ w, -30, 30))), BINS - 1).astype(int)
        return np.concatenate([np.bincount(b, minlength=BINS) for b in (bin_, bin_[pdf["y"].to_numpy(float) == 1])])

    every, good = _summed(rows, 2 * BINS, of).reshape(2, BINS)
    return every, good


def _link(rows: DataFrame, model: Model) -> tuple[float, float]:
    """Intercept and slope from a bounded sample of training labels, by Newton steps; the slope is never negative."""
    taken = [rows.where(F.col("y") == c).orderBy(F.xxhash64("id"), "id").select("x", "y").limit(SAMPLE) for c in (0, 1)]
    size = {r["y"]: r["n"] for r in rows.where("y IS NOT NULL").groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return 0.0, 1.0
    got = taken[0].unionByName(taken[1]).toPandas()
    y = got["y"].to_numpy(float)
    z = model.logits(np.stack(got["x"].to_numpy()))
    weight = np.where(y == 1, size[1] / min(size[1], SAMPLE), size[0] / min(size[0], SAMPLE))
    a, b = np.column_stack([np.ones(len(z)), z]), np.array([0.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        grad = a.T @ (weight * (y - p)) - np.array([0, 0.1 * b[1]])
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + np.eye(2) * 0.1
        b = b + np.clip(np.linalg.solve(hess, grad), -2, 2)
    return (float(b[0]), float(b[1])) if b[1] > 0 else (0.0, 1.0)


def score(x: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def of(s: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(s.to_numpy())) if len(s) else [], dtype="float64")
    return of(x)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, score, predicted) per row of ``docs``; other columns are
    left out. Null and empty texts are scored like any other; labels that are
    null or neither 0 nor 1, or without an id, teach nothing; of repeated labels
    the largest counts; repeated rows get equal scores; an empty table gives no
    rows."""
    rows = with_features(docs, labels, label, id_col, text_col)
    scored = rows.select(F.col("id").alias(id_col), score(F.col("x"), train(rows)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
