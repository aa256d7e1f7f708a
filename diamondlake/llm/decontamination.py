"""Benchmark decontamination by the q-gram lemma.

A passage of m characters that occurs in a text with at most k edits shares at
least m + 1 - q - k * q of its q-grams with it, all of them on k + 1 neighbouring
diagonals. Each text is scanned once: q-gram hits against the benchmark's
index are counted in diagonal bands that overlap by half, so that every such run of
diagonals lies in one band; bands that reach a passage's bound are verified by
banded alignment (edit distance of the passage against any part of the
region).

An item is searched for whole (in overlapping windows if it is long) and in short
pieces at a small stride, one of which decides: any part of an item of
``SHORT + STEP - 1`` characters holds a whole short piece, so that a leak of a part
is found wherever it starts. Items too short for q-grams are searched word for word.

The benchmark is searched in blocks of ``BLOCK_CHARS`` characters. A block
travels to the workers in the task; a larger benchmark takes more passes over the
documents, so nothing that grows is broadcast. Documents aren't shuffled."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

Q, EDIT_RATE = 10, 0.06
#: Passages are pieces of an item: the whole item, or if it is longer, overlapping pieces of this many characters.
PIECE, STRIDE = 256, 128
#: Besides, an item's parts: pieces of this many characters, one at each STEP characters.
SHORT, STEP = 48, 16
#: Items of fewer characters (white space collapsed) are searched without edits, between word borders.
MIN_CHARS = 24
BLOCK_CHARS = 4 << 20
#: Characters of a text that are scanned at once; scans overlap by more than a match can span.
SCAN = 1 << 20
#: Hits that are counted at once, whatever their number in a text.
SLICE = 1 << 19
#: Alignments that are remembered; beyond it they are forgotten and made again.
ALIGNED = 1 << 16

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22

#: Letters and digits of scripts that put spaces between words.
_WORD = re.compile(r"(?![\u0e00-\U0010ffff])[^\W_]")

FOUND = "array<struct<item_id: {}, start: bigint, end: bigint, edits: int, piece: bigint>>"


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of each q-gram, by doubling: the grams of 1, 2, 4 ... characters
    make up those of q."""
    if len(codes) < q:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        power, have, whole, done = _MULT, (codes + np.uint64(1)) * _MULT, None, 0
        width = 1
        while True:
            if q & width:
                if whole is None:
                    whole, done = have, width
                else:
                    n = len(codes) - done - width + 1
                    whole, done = whole[:n] * power + have[done:done + n], done + width
            if done == q:
                break
            n = len(have) - width
            have, power, width = have[:n] * power + have[width:width + n], power * power, 2 * width
        return (whole ^ (whole >> np.uint64(29))) * _MULT


def starts(size: int, piece: int, step: int) -> list[int]:
    """Starts of the pieces of ``size`` characters, the last of which ends with them."""
    return [0] if size <= piece else sorted({*range(0, size - piece, step), size - piece})


def band_distance(piece: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """Fewest edits that turn ``piece`` into some part of ``text`` along the
    diagonals ``low`` to ``high`` (text position less piece position), and that
    part's bounds; None if there are more than ``most``."""
    width, far = high - low + 1, most + 1
    at = np.arange(low, high + 1)
    inside = (at >= 0) & (at <= len(text))
    row = np.where(inside, 0, far).astype(np.int64)
    begin = np.where(inside, at, -1)
    steps = np.arange(width)
    for i, c in enumerate(piece):
        pos = at + i  # text character that the diagonal step consumes
        ok = (pos >= 0) & (pos < len(text))
        same = np.zeros(width, dtype=bool)
        same[ok] = text[pos[ok]] == c
        take = np.where(ok, row + ~same, far)
        skip = np.append(row[1:] + 1, far)  # the piece's character has no partner
        new = np.minimum(take, skip)
        new_begin = np.where(take <= skip, begin, np.append(begin[1:], -1))
        # A text character without a partner: each cell may come from any to its left.
        shifted = new - steps
        run = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == run, steps, 0))
        row, begin = np.minimum(run + steps, far), new_begin[source]
        if row.min() > most:
            return None
    ends = at + len(piece)
    row = np.where((ends >= 0) & (ends <= len(text)), row, far)
    k = int(row.argmin())
    return (int(row[k]), int(begin[k]), int(ends[k])) if row[k] <= most else None


@dataclass
class Index:
    """q-gram index of a block of benchmark items, built where it is used.
    Pieces that several items share are indexed and counted once."""

    items: tuple[tuple[int | str | None, str], ...]
    q: int = Q
    rate: float = EDIT_RATE

    def __post_init__(self) -> None:
        uses: list[tuple[int, int, np.ndarray]] = []  # item, start, characters
        part: list[bool] = []  # a short piece, which counts where no long one of its item is found
        exact: dict[str, list[int]] = {}
        for n, (_, text) in enumerate(self.items):
            codes = _codes(whole := normal(text))
            if len(codes) < MIN_CHARS:
                exact.setdefault(whole, []).append(n)
                continue
            long = [(n, s, codes[s:s + PIECE]) for s in starts(len(codes), PIECE, STRIDE)]
            short = [(n, s, codes[s:s + SHORT]) for s in starts(len(codes), SHORT, STEP)] if len(codes) > SHORT else []
            uses += long + short
            part += [False] * len(long) + [True] * len(short)
        exact.pop("", None)
        self.aligned: dict[tuple[int, int, str], tuple[int, int, int] | None] = {}
        self.words = ahocorasick.Automaton() if exact else None
        for whole, users in exact.items():
            self.words.add_word(whole, (len(whole), users))
        if exact:
            self.words.make_automaton()
        known: dict[str, int] = {}
        self.pieces: list[np.ndarray] = []  # distinct characters
        self.uses: list[tuple[int, int, int, bool]] = []  # piece, item, start, part
        for (item, start, codes), short in zip(uses, part, strict=True):
            chars = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            if (p := known.setdefault(chars, len(known))) == len(self.pieces):
                self.pieces.append(codes)
            self.uses.append((p, item, start, short))
        self.exact = list(known)
        self.used = np.array([u[0] for u in self.uses], dtype=np.int64)
        sizes = np.array([len(p) for p in self.pieces], dtype=np.int64)
        # Fewer edits for short pieces, where the lemma's bound would vanish.
        self.edits = np.minimum((sizes * self.rate).astype(np.int64), (sizes - self.q) // self.q)
        self.need = sizes + 1 - self.q - self.edits * self.q
        self.half = int(self.edits.max()) + 1 if len(sizes) else 1
        grams = [gram_hashes(p, self.q) for p in self.pieces]
        keys = np.concatenate(grams) if grams else np.empty(0, dtype=np.uint64)
        piece = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        at = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.piece, self.at = piece[order], at[order]
        self.keys, self.first, self.count = np.unique(keys[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << _BITS, dtype=bool)
        self.seen[(self.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def hits(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Slices of (piece, diagonal) of each shared q-gram, in order of the text,
        of ``SLICE`` hits or those of one position, and the least diagonal of the hits to come."""
        h = gram_hashes(codes, self.q)
        pos = np.nonzero(self.seen[(h >> np.uint64(64 - _BITS)).astype(np.int64)])[0]
        if not len(pos) or not len(self.keys):
            return
        key = np.minimum(np.searchsorted(self.keys, h[pos]), len(self.keys) - 1)
        real = self.keys[key] == h[pos]
        pos, key = pos[real], key[real]
        total = np.cumsum(self.count[key])
        i = 0
        while i < len(pos):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + SLICE, side="right")))
            n = self.count[key[i:j]]
            row = np.repeat(self.first[key[i:j]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield self.piece[row], np.repeat(pos[i:j], n) - self.at[row], int(pos[j]) - PIECE if j < len(pos) else len(codes) + PIECE
            i = j

    def bands(self, codes: np.ndarray) -> dict[int, list[int]]:
        """First diagonals, in order, of the bands that reach their piece's
        bound, by piece. A band is two neighbouring bins of diagonals. Only bins that
        later hits may still reach are kept while the text goes by."""
        span = (len(codes) + 4 * PIECE) // self.half + 4
        key, n = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        judged, out = 0, {}  # bands below this bin are judged
        for piece, diagonal, least in self.hits(codes):
            new = piece * span + (diagonal + 2 * PIECE) // self.half + 1  # diagonals start at -PIECE
            key, n = _counted(np.concatenate([key, new]), np.concatenate([n, np.ones(len(new), dtype=np.int64)]))
            whole = (least + 2 * PIECE) // self.half + 1  # bins below this one are complete
            band, total = _counted(np.concatenate([key, key - 1]), np.concatenate([n, n]))
            bin_ = band % span
            good = (total >= self.need[band // span]) & (bin_ >= judged) & (bin_ < whole - 1)
            for k in band[good]:
                out.setdefault(int(k // span), []).append((int(k % span) - 1) * self.half - 2 * PIECE)
            judged = max(judged, whole - 1)
            open_ = key % span >= judged
            key, n = key[open_], n[open_]
        return out

    def search(self, text: str | None) -> list[tuple[int | str | None, int, int, int, int]]:
        """Leaks of a whole text, one for each item: (item id, start, end,
        edits, start in the item), in characters of the normal form; of a leaked
        part, one piece."""
        best: dict[int, tuple[bool, int, int, int, int]] = {}
        whole = normal(text)
        overlap = PIECE + 4 * self.half
        for base in range(0, max(1, len(whole) - overlap), SCAN):
            bands = self.bands(_codes(whole[base:base + SCAN + overlap]))
            for u in np.nonzero(np.isin(self.used, list(bands)))[0] if bands else ():
                p, item, start, part = self.uses[u]
                for low in bands[p]:
                    if item in best and best[item] < (part, 1):  # as long, without edits, or longer
                        break
                    if found := self._verified(p, base + low, whole):
                        hit = (part, *found, start)
                        best[item] = min(best.get(item, hit), hit)
        for end, (length, users) in self.words.iter(whole) if self.words else ():
            s, e = end + 1 - length, end + 1
            if not (s and _WORD.match(whole[s - 1]) and _WORD.match(whole[s]) or e < len(whole) and _WORD.match(whole[e - 1]) and _WORD.match(whole[e])):
                for item in users:
                    best.setdefault(item, (False, 0, s, e, 0))
        return [(self.items[i][0], s, e, k, at) for i, (_, k, s, e, at) in sorted(best.items())]

    def _verified(self, p: int, low: int, whole: str) -> tuple[int, int, int] | None:
        """(edits, start, end) of a piece in the region of a band, if it is
        there. A region of the same characters is aligned once, wherever it stands."""
        most, size = int(self.edits[p]), len(self.pieces[p])
        low, high = low - most, low + 2 * self.half - 1 + most
        at = max(0, low)
        region = whole[at:max(0, high) + size]
        if (key := (p, low - at, region)) not in self.aligned:
            if len(self.aligned) >= ALIGNED:
                self.aligned.clear()
            exact = region.find(self.exact[p])
            self.aligned[key] = (0, exact, exact + size) if exact >= 0 else band_distance(self.pieces[p], _codes(region), low - at, high - at, most)
        found = self.aligned[key]
        return found and (found[0], at + found[1], at + found[2])


def _counted(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.nonzero(np.r_[True, key[1:] != key[:-1]])[0] if len(key) else np.empty(0, dtype=np.int64)
    return key[first], np.add.reduceat(n, first) if len(key) else n


@lru_cache(maxsize=2)
def index_of(items: tuple[tuple[int | str | None, str], ...], q: int, rate: float) -> Index:
    """The index of a block, built once in each worker process."""
    return Index(items, q, rate)


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[tuple[tuple[int | str | None, str], ...]]:
    """The benchmark's items in blocks of bounded size, each sent to the driver alone."""
    items = benchmark.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // (block_chars // 2)))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield tuple(sorted(((r["id"], r["text"]) for r in part.toLocalIterator()), key=lambda x: (x[0] is None, 0 if x[0] is None else x[0], x[1])))


def leaks(text: Column, items: tuple[tuple[int | str | None, str], ...], q: int = Q, rate: float = EDIT_RATE, id_type: str = "bigint") -> Column:
    """Array of the leaks of a text against a block of items; null counts as empty."""
    @F.pandas_udf(FOUND.format(id_type))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = index_of(items, q, rate)
        names = ("item_id", "start", "end", "edits", "piece")
        for s in batches:
            yield pd.Series([[dict(zip(names, x, strict=True)) for x in index.search(t)] for t in s], dtype=object)
    return of(text)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document row and benchmark item that leaked into it: the id,
    item_id, start, end, edits, piece (where the matching part starts in the
    item). Ids are whole numbers or strings. Documents without leaks, null or empty texts, empty tables: no
    rows. Repeated documents have a row each; items that repeat under one id count
    once."""
    out, id_type = None, benchmark.schema["item_id"].dataType.simpleString()
    for items in blocks(benchmark):
        part = docs.select(F.col(id_col), F.explode(leaks(F.col(text_col), items, id_type=id_type, **options)).alias("leak"))
        part = part.select(id_col, "leak.item_id", "leak.start", "leak.end", "leak.edits", "leak.piece")
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows into which a benchmark item leaked, all columns kept."""
    columns, id_type = [F.col(f"`{c}`") for c in docs.columns], benchmark.schema["item_id"].dataType.simpleString()
    for items in blocks(benchmark):
        (n,) = fresh(docs, "leaks")
        docs = docs.withColumn(n, F.size(leaks(F.col(text_col), items, id_type=id_type, **options))).where(F.col(n) == 0).select(*columns)
    return docs
