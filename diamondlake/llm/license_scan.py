"""Fuzzy search for short licence notices.

Texts are reduced to their words (A-Z lower-cased) with single spaces between.
A notice that may have k edits is split into k + 1 pieces: at least one stands
unchanged in every match (pigeonhole). One automaton finds all pieces in one
pass; around each hit, if enough of the notice's grams stand there (q-gram lemma),
the regex library verifies the notice with its edit bound and gives the span. Phrases with no edits allowed are the case k = 0, whose
single piece is the phrase, followed by an exact check of word borders."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}

# Phrases with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Short notices with their labels; in words of lower case.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under the apache license": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nd": "cc-by-nd",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
#: One edit allowed for so many characters of a notice.
CHARS_PER_EDIT = 14
#: Length of the grams counted before a window is verified.
GRAM = 3


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    edits: int

    @cached_property
    def pattern(self) -> regex.Pattern:
        return regex.compile(f"(?b)(?:{regex.escape(self.text)}){{e<={self.edits}}}")

    @cached_property
    def grams(self) -> list[str]:
        return [self.text[i:i + GRAM] for i in range(len(self.text) - GRAM + 1)]

    def possible(self, window: str) -> bool:
        """Whether ``window`` may hold the notice: an edit takes away GRAM of its grams at most (q-gram lemma)."""
        spare = GRAM * self.edits
        for g in self.grams:
            if g not in window:
                spare -= 1
                if spare < 0:
                    return False
        return True

    def pieces(self) -> list[tuple[int, str]]:
        """(start, piece) of edits + 1 pieces."""
        n = self.edits + 1
        cuts = [len(self.text) * i // n for i in range(n + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def notices(table: dict[str, str] = NOTICES, chars_per_edit: int = CHARS_PER_EDIT) -> list[Notice]:
    """Notices of over one edit's length; single edits inside words of short ones would change their sense."""
    return [Notice(f" {t} ", label, len(t) // chars_per_edit) for t, label in table.items()]


class Scanner:
    """Automaton of all pieces of exact phrases and fuzzy notices."""

    def __init__(self, base: dict[str, str] = BASE, table: dict[str, str] = NOTICES) -> None:
        self.base, self.notices = [(f" {p} ", label) for p, label in base.items()], notices(table)
        seeds: dict[str, list[tuple[bool, int, int]]] = {}
        for k, (p, _) in enumerate(self.base):
            seeds.setdefault(p, []).append((True, k, 0))
        for k, n in enumerate(self.notices):
            for at, piece in n.pieces():
                seeds.setdefault(piece, []).append((False, k, at))
        self.machine = ahocorasick.Automaton()
        for piece, users in seeds.items():
            self.machine.add_word(piece, (len(piece), users))
        self.machine.make_automaton()

    def scan(self, text: str | None) -> dict:
        """Words, places of the base phrases as word numbers, and matches
        (label, first word, last word, edits) of the notices; null counts as empty."""
        words = WORD.findall((text or "").translate(_LOWER))
        line = f" {' '.join(words)} "
        places: set[tuple[int, int]] = set()
        windows: set[tuple[int, int, int]] = set()
        for end, (length, users) in self.machine.iter(line):
            start = end + 1 - length
            for exact, k, at in users:
                if exact:
                    places.add((start, k))
                else:
                    n = self.notices[k]
                    lo = max(0, start - at - n.edits)
                    hi = min(len(line), start - at + len(n.text) + n.edits)
                    windows.add((k, lo, hi))
        # Each seed hit is verified in its own window: of two neighbours, neither hides the other. Equal windows are verified once.
        spans = set()
        verified: dict[tuple[int, str], tuple[int, int, int] | None] = {}
        for k, lo, hi in windows:
            n, window = self.notices[k], line[lo:hi]
            if (k, window) not in verified:
                m = n.pattern.search(window) if n.possible(window) else None
                verified[k, window] = (m.start(), m.end(), sum(m.fuzzy_counts)) if m else None
            if found := verified[k, window]:
                spans.add((lo + found[0], lo + found[1], n.label, found[2], n.edits, k))
        # Of overlapping matches (two may share a border space), those with the fewest edits, of one notice the first.
        spans = sorted(spans, key=lambda m: (m[3], m[0], m[1], m[2], m[5]))
        best: list[tuple[int, int, str, int, int, int]] = []
        taken: dict[int, list[tuple[int, int, int, int]]] = {}
        for m in spans:
            cells = range(m[0] // 64, m[1] // 64 + 1)
            if all(e <= m[0] + 1 or s >= m[1] - 1 or d == m[3] and k != m[5] for c in cells for s, e, d, k in taken.get(c, ())):
                best.append(m)
                for c in cells:
                    taken.setdefault(c, []).append((m[0], m[1], m[3], m[5]))
        spans = best
        # Word numbers, by one walk over the starts in order.
        marks = sorted({s for s, _ in places} | {x for s, e, *_ in spans for x in (s, max(s, e - 2))})
        number, at, count = {}, 0, 0
        for x in marks:
            count += line.count(" ", at, x + 1)
            at, number[x] = x + 1, max(count - 1, 0)
        return {
            "n_words": len(words),
            "places": sorted((number[s], self.base[k][1]) for s, k in places),
            "matches": sorted((label, number[s], number[max(s, e - 2)], edits, 1 - edits / (limit + 1)) for s, e, label, edits, limit, _ in spans),
        }


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] = BASE, table: dict[str, str] = NOTICES) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word
    (null without places), base_labels, labels (sorted, comma-joined), score (best
    match: 1 for an exact one, 0 for none) and ``matches`` (label, first and
    last word, edits). Other columns are left out.

    Null and empty texts have no words; texts are searched whole; repeated rows each keep a row; an empty table gives no rows."""
    schema = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
              "matches array<struct<label: string, first_word: bigint, last_word: bigint, edits: int>>")

    @F.pandas_udf(schema)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(base, table)
        for s in batches:
            out = []
            for text in s:
                r = scanner.scan(text)
                places, matches = r["places"], r["matches"]
                known = {label for _, label in places}
                best = 1.0 if places else max((m[4] for m in matches), default=0.0)
                out.append((r["n_words"], len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted(known)),
                            ",".join(sorted(known | {m[0] for m in matches})), best, [dict(zip(("label", "first_word", "last_word", "edits"), m, strict=False)) for m in matches]))
            frame = pd.DataFrame(out, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])
            yield frame.astype({"n_words": "int64", "n_base": "int64", "first_word": "Int64", "last_word": "Int64", "score": "float64"})

    got, = fresh(docs, "scan")
    return docs.select(F.col(id_col), of(F.col(text_col)).alias(got)).select(id_col, f"{got}.*")
