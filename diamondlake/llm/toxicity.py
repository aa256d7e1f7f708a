"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses. A lexical transducer (a prefix tree with a weight
at each node) maps each word to a symbol: insult, threat, target, negation,
reported speech or other. Small transducers over those symbols follow
negation, reported speech, targets and threats; they are composed into one machine whose arcs
multiply their weights, so an insult aimed at somebody counts more than one
that is denied or quoted. Clauses, not isolated words, get scores; a logistic
link turns a document's clause scores into a probability.

The insult weights come from labelled documents: smoothed log-odds of words and word
beginnings, each node backing off to its parent, learned from a bounded sample
(``SAMPLE`` documents of each class, those with the smallest id hashes). For
the link's fit a labelled document's own counts are taken out of the weights."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, is_training

#: Labelled documents of each class that the lexicon and the link are learned from.
SAMPLE = 4000
PREFIX = range(3, 9)
THRESHOLD = 0.7

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:\n|]+")

# Words of the grammar's classes.
SEED_INSULTS = "idiot idiots stupid moron morons loser losers scum trash worthless pathetic disgusting clown dumb imbecile dumm idiotisch abschaum crétin imbécile connard estúpido imbécil basura".split()
THREATS = "kill hurt destroy beat burn stab shoot töten umbringen schlagen tuer frapper détruire matar golpear destruir".split()
TARGETS = "you your you're they them he she him her people du dich dir ihr euch sie tu toi te vous ils eux tú ti usted ustedes ellos".split()
NEGATIONS = "not no never nobody isn't aren't don't without nicht kein keine keinen nie niemals ne pas jamais aucun nunca jamás ningún ninguna".split()
REPORTS = "said says say called calls wrote claimed quoted reported sagte sagt nannte schrieb behauptete dit disait appelé écrit dijo dice llamó escribió".split()

SEED_WEIGHT = 2.0
#: Link used where no labels of both classes are given.
DEFAULT_LINK = (-2.5, 0.6, 0.8, 0.3, 0.2)


@dataclass(frozen=True)
class Transducer:
    """Deterministic weighted machine over the symbols I T G N R X: ``arcs``
    maps (state, symbol) to (state, factor); arcs not named stay at factor 1,
    or move as ``X`` does."""

    start: str
    arcs: dict[tuple[str, str], tuple[str, float]]

    def step(self, state: str, symbol: str) -> tuple[str, float]:
        hit = self.arcs.get((state, symbol))
        if hit is None:
            hit = (self.arcs.get((state, "X"), (state, 1.0))[0], 1.0)
        return hit


#: Words shortly after a negation count less.
NEGATION = Transducer("0", {
    **{(s, "N"): ("3", 1.0) for s in "0123"},
    **{(s, "I"): (str(int(s) - 1), 0.5) for s in "123"},
    **{(s, "T"): (str(int(s) - 1), 0.3) for s in "123"},
    **{(s, "X"): (str(int(s) - 1), 1.0) for s in "123"},
})
#: After a verb of saying, the clause is somebody else's words.
REPORTED = Transducer("own", {("own", "R"): ("other", 1.0), ("other", "I"): ("other", 0.6), ("other", "T"): ("other", 0.4)})
#: Aimed at somebody.
AIMED = Transducer("open", {("open", "G"): ("aimed", 1.0), ("aimed", "I"): ("aimed", 1.25), ("aimed", "T"): ("aimed", 1.5), ("open", "T"): ("threat", 0.2), ("threat", "G"): ("aimed", 1.0), ("threat", "I"): ("threat", 1.25)})
#: Insults that pile up in a clause.
PILED = Transducer("none", {("none", "I"): ("some", 1.0), ("some", "I"): ("some", 1.1), ("none", "T"): ("some", 1.0)})

SYMBOLS = "ITGNRX"


def compose(*machines: Transducer) -> tuple[int, list[dict[str, tuple[int, float]]]]:
    """The product machine: its start state and, by state, (state, factor) by symbol."""
    start = tuple(m.start for m in machines)
    number, todo, table = {start: 0}, [start], []
    for state in todo:
        row = {}
        for symbol in SYMBOLS:
            moved = [m.step(s, symbol) for m, s in zip(machines, state, strict=True)]
            to = tuple(x[0] for x in moved)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row[symbol] = (number[to], math.prod(x[1] for x in moved))
        table.append(row)
    return 0, table


def nodes_of(word: str) -> list[str]:
    """Lexicon nodes of a word from short to long: its beginnings, then itself."""
    return [word[:k] + "*" for k in PREFIX if k < len(word)] + [word]


@dataclass
class Lexicon:
    """Prefix tree with document counts: node -> (toxic, clean)."""

    counts: dict[str, tuple[int, int]] = field(default_factory=dict)
    accepted: frozenset[str] = frozenset()
    toxic: int = 0
    clean: int = 0
    strength: float = 3.0

    def __post_init__(self) -> None:
        self.heads = {n.rstrip("*")[:3] for n in self.counts} | {w[:3] for w in SEED_INSULTS}
        self.cache: dict[str, float] = {}

    def weight(self, word: str, label: int | None = None) -> float:
        """Log-odds of a word, 0 at least; with ``label``, as if a document of that label weren't counted."""
        if label is None and word in self.cache:
            return self.cache[word]
        drop1, drop0 = label == 1, label == 0
        scale = max(self.toxic - drop1, 1) / max(self.clean - drop0, 1)
        # Both shares are kept: one minus a share near 1 would round to zero.
        bad, good, known, found = 0.5, 0.5, False, word in SEED_INSULTS and not self.toxic
        for node in nodes_of(word):
            n = self.counts.get(node)
            if n is None:
                continue
            known = known or node in self.accepted
            n1, n0 = max(n[0] - drop1, 0), max(n[1] - drop0, 0) * scale
            bad, good = ((n + self.strength * share) / (n1 + n0 + self.strength) for n, share in ((n1, bad), (n0, good)))
        w = math.log(bad) - math.log(good) if known else SEED_WEIGHT if found else 0.0
        w = max(w, 0.0)
        if label is None and len(self.cache) < 200_000:
            self.cache[word] = w
        return w


class Grammar:
    """The composed machine over a lexicon."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.start, self.table = compose(NEGATION, REPORTED, AIMED, PILED)
        self.symbol = {w: s for s, words in (("T", THREATS), ("G", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) for w in words}

    def clause(self, words: list[str], label: int | None = None) -> tuple[float, int]:
        """Score of a clause and the number of its insults and threats."""
        state, total, hits, threat = self.start, 0.0, 0, False
        for w in words:
            weight = self.lexicon.weight(w, label) if w[:3] in self.lexicon.heads else 0.0
            symbol = "I" if weight >= 1.0 else self.symbol.get(w, "X")
            state, factor = self.table[state][symbol]
            if symbol == "I":
                total, hits = total + weight * factor, hits + 1
            elif symbol == "T":
                total, hits = total + 0.5 * factor, hits + 1
        return total, hits

    def features(self, text: str | None, label: int | None = None) -> tuple[float, float, float, float]:
        """Best clause, all clauses, matches and density of a whole text."""
        low = (text or "").lower()
        words = WORD.findall(low)
        heads, symbol = self.lexicon.heads, self.symbol
        if not any(w[:3] in heads and self.lexicon.weight(w, label) >= 1.0 or symbol.get(w) == "T" for w in set(words)):
            return 0.0, 0.0, 0.0, 0.0
        best = total = 0.0
        hits = 0
        for part in CLAUSE.split(low):
            score, n = self.clause(WORD.findall(part), label)
            best, total, hits = max(best, score), total + score, hits + n
        return min(best, 8.0), math.log1p(total), math.log1p(hits), math.log1p(100 * total / (len(words) + 20))


@dataclass
class Model:
    lexicon: Lexicon
    link: tuple[float, ...] = DEFAULT_LINK

    def score(self, grammar: Grammar, text: str | None) -> float:
        z = self.link[0] + sum(a * b for a, b in zip(self.link[1:], grammar.features(text), strict=True))
        return 1 / (1 + math.exp(-max(min(z, 30.0), -30.0)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE) -> DataFrame:
    """(id, text, y, weight) of ``per_class`` training documents of each class
    at most, those with the smallest id hashes; weight restores the classes'
    shares. An id that repeats counts once, with its largest label and text."""
    y = labels.where(F.col(id_col).isNotNull() & is_training(F.col(id_col)) & F.col(label).isin(0, 1))
    y = y.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y"))
    shares = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = [y.where(F.col("y") == k).orderBy(F.xxhash64("id"), "id").limit(per_class) for k in (0, 1)]
    ids = checkpoint(picked[0].unionByName(picked[1]))
    weight = F.create_map(*(x for k in (0, 1) for x in (F.lit(k), F.lit(shares.get(k, 0) / max(1, min(per_class, shares.get(k, 0)))))))
    # At most 2 * per_class ids: bounded by the parameter.
    found = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(ids), "id")
    return checkpoint(found.groupBy("id", "y").agg(F.max("text").alias("text")).withColumn("weight", weight[F.col("y")]))


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Document counts of words and word beginnings by class, summed by Spark;
    the accepted nodes and all that share their first letters and occur in two
    documents at least come to the driver: the sample bounds them."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = (Counter(), Counter())
            for text, y in zip(pdf["text"], pdf["y"], strict=True):
                n[y].update({k for w in set(WORD.findall(text.lower())) for k in nodes_of(w)})
            keys = list(n[0].keys() | n[1].keys())
            yield pd.DataFrame({"node": keys, "n1": [n[1][k] for k in keys], "n0": [n[0][k] for k in keys]})

    by_class = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = by_class.get(1, 0), by_class.get(0, 0)
    if not toxic or not clean:
        return Lexicon()
    counts = sample.select("text", "y").mapInPandas(count, "node string, n1 long, n0 long").groupBy("node").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    counts = checkpoint(counts.where("n1 + n0 > 1"))
    odds = F.log((F.col("n1") + 0.5) / (toxic + 1)) - F.log((F.col("n0") + 0.5) / (clean + 1))
    sure = odds / F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    good = counts.withColumn("odds", odds).withColumn("sure", sure).where("n1 >= 3 AND odds > 1.5 AND sure > 3.5")
    accepted = [r["node"] for r in good.select("node").collect()]
    if not accepted:
        return Lexicon(toxic=toxic, clean=clean)
    head = F.substring("node", 1, 3).alias("head")
    below = counts.select("*", head).join(good.select(head).distinct(), "head", "left_semi").collect()
    return Lexicon({r["node"]: (r["n1"], r["n0"]) for r in below}, frozenset(accepted), toxic, clean)


def fit_link(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Weighted ridge logistic regression by Newton steps; no negative slopes."""
    free = list(range(x.shape[1]))
    while True:
        a = np.column_stack([np.ones(len(x)), x[:, free]])
        b, w = np.zeros(a.shape[1]), weight / weight.mean()
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
            grad = a.T @ (w * (y - p)) - ridge * len(x) * b * (np.arange(len(b)) > 0) * 0.1
            hess = (a * (w * p * (1 - p))[:, None]).T @ a + np.eye(len(b)) * (ridge * len(x) * 0.1 + 1e-9)
            step = np.linalg.solve(hess, grad)
            b = b + np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-8:
                break
        bad = [k for k, v in zip(free, b[1:], strict=True) if v < 0]
        if not bad:
            out = np.zeros(x.shape[1] + 1)
            out[0], out[[k + 1 for k in free]] = b[0], b[1:]
            return tuple(float(v) for v in out)
        free = [k for k in free if k not in bad]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE) -> Model:
    """Lexicon and link from the training rows of ``labels``. Without labels of
    both classes: the built-in insults and the default link."""
    sample = labelled_sample(docs, labels, label, id_col, text_col, per_class)
    lexicon = learn_lexicon(sample)
    if not lexicon.toxic:
        return Model(lexicon)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar = Grammar(lexicon)
        for pdf in batches:
            f = [grammar.features(t, int(y)) for t, y in zip(pdf["text"], pdf["y"], strict=True)]
            yield pd.DataFrame(f, columns=list("abcd")).astype(float).assign(y=pdf["y"].to_numpy(), weight=pdf["weight"].to_numpy())

    rows = sample.mapInPandas(features, "a double, b double, c double, d double, y int, weight double").toPandas()
    rows = rows.sort_values(list(rows.columns), ignore_index=True)  # the same sums whatever the order of tasks
    return Model(lexicon, fit_link(rows[list("abcd")].to_numpy(), rows["y"].to_numpy(float), rows["weight"].to_numpy()))


def score(text: Column, model: Model) -> Column:
    """Probability that a whole text is toxic; null counts as empty."""
    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grammar = Grammar(model.lexicon)
        for s in batches:
            yield pd.Series([model.score(grammar, t) for t in s], dtype="float64")
    return of(text)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns
    kept. Empty and null texts have no clauses and stay; repeated rows get
    equal scores; an empty table gives no rows."""
    return docs.where(score(F.col(text_col), model) < threshold)
