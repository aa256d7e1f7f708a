"""Scalar column functions (F1-F11) plus the deterministic rounding used by
every computed ratio.  All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters without a decomposition and their ASCII forms, same positions; letters that fold to two.
PLAIN_LETTERS, PLAIN_FORMS = "øØłŁđĐðÐħĦŧŦıſ", "oOlLdDdDhHtTis"
TWO_LETTERS = {"ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th", "ĳ": "ij", "Ĳ": "IJ"}

#: Those that are looked for by themselves, as they are frequent.
COMMON = "ßæœ"


def _folded() -> dict[str, str]:
    """Every letter below U+2000 with a canonical decomposition and its base letter
    (Latin, Greek, Cyrillic and others). Marks count if they have a combining class, so
    the vowel signs of Indic scripts stay."""
    plain = dict(zip(PLAIN_LETTERS, PLAIN_FORMS, strict=True))
    out = {}
    for code in range(0xC0, 0x2000):
        letter = chr(code)
        parts = unicodedata.normalize("NFD", letter)
        base = "".join(c for c in parts if not unicodedata.combining(c))
        if unicodedata.category(letter)[0] == "L" and len(base) == 1:
            base = plain.get(base, base)
            if base != letter:
                out[letter] = base
    return out


FOLDED = _folded()
#: Combining marks of decomposed text.
MARKS = "".join(map(chr, range(0x300, 0x370)))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int) -> Column:
    """ROUND half-up on the binary double value: floor(x*10^d + 0.5)/10^d.
    Plain IEEE arithmetic, so every engine that evaluates it gets the same bits."""
    scale = 10 ** digits
    return (F.floor(_c(c).cast("double") * scale + 0.5) / scale)


def round_half_up_sql(expr: str, digits: int) -> str:
    return f"(FLOOR(CAST({expr} AS DOUBLE) * {10 ** digits} + 0.5) / {10 ** digits})"


def anchor_text(c) -> Column:
    """text of the first ``>...<`` span (anchor tag), NULL when absent."""
    return F.nullif(F.regexp_extract(_c(c), r">(.*?)<", 1), F.lit(""))


def link_text(c) -> Column:
    """F1 on a whole page: text of the first ``<a>`` element, NULL when absent or empty."""
    return F.nullif(F.regexp_extract(_c(c), r"(?s)<a(\s[^>]*)?>(.*?)</a>", 2), F.lit(""))


def swap_name(c) -> Column:
    """"Last, First" -> "First Last" (split at the first comma); no comma -> unchanged."""
    col = _c(c)
    before = F.substring_index(col, ",", 1)
    rest = F.substr(col, F.instr(col, ",") + 1)
    return F.when(F.instr(col, ",") > 0, F.concat_ws(" ", F.trim(rest), F.trim(before))).otherwise(col)


def strip_accents(c) -> Column:
    """accented letters become their base letters by a table made from the
    Unicode decompositions, marks of decomposed text go, and letters that fold to
    two are replaced where a text has one. Texts without a letter beyond ASCII stay as they are."""
    text = _c(c)
    plain = some = F.translate(text, "".join(FOLDED) + MARKS, "".join(FOLDED.values()))
    for letter in COMMON:
        some = F.replace(some, F.lit(letter), F.lit(TWO_LETTERS[letter]))
    rare = [x for x in TWO_LETTERS if x not in COMMON]
    every = some
    for letter in rare:
        every = F.replace(every, F.lit(letter), F.lit(TWO_LETTERS[letter]))
    # Each text takes the shortest chain of passes that folds all its letters.
    return (F.when(text.rlike(f"[{''.join(rare)}ǢǼ]"), every).when(text.rlike(f"[{COMMON}ǣǽ]"), some)
            .when(text.rlike("[^\\x00-\\x7F]"), plain).otherwise(text))


def first_two_words(c) -> Column:
    """first two whitespace-separated words."""
    return F.array_join(F.slice(F.split(F.trim(_c(c)), r"\s+"), 1, 2), " ")


def percent_to_fraction(c) -> Column:
    """'10.9%' -> 0.109; unparsable -> NULL."""
    return F.try_divide(F.regexp_replace(_c(c), "%$", "").try_cast("double"), F.lit(100.0))


def winner_tiebreak(home_team, away_team, home_primary, away_primary, home_secondary,
                    away_secondary) -> Column:
    """higher primary score wins; tie -> higher secondary; tie -> NULL."""
    hp, ap, hs, as_ = map(_c, (home_primary, away_primary, home_secondary, away_secondary))
    return (F.when(hp > ap, _c(home_team)).when(ap > hp, _c(away_team))
            .when(hs > as_, _c(home_team)).when(as_ > hs, _c(away_team)))


def json_int_field(c, field: str) -> Column:
    """integer field of a JSON object string."""
    return F.get_json_object(_c(c), f"$.{field}").try_cast("int")


def safe_ratio(num, den, digits: int | None = 4) -> Column:
    """Guarded division, NULL when the denominator is 0/NULL."""
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    r = F.when(_c(den) != 0, r)
    return round_half_up(r, digits) if digits is not None else r
