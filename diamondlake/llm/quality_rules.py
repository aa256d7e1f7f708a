"""Quality rules: a table of thresholds compiled into one Spark projection.

Each document's measures (lengths, symbols, stop words, line shapes, repeated
windows) are built-in Spark expressions over that row alone: no shuffle, no
user function. ``RULES`` is data; ``failures`` turns it into one array
expression of the names of the rules that a row breaks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RE, SPACES, WORD_RE, fresh, word_count

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Common function words of the four languages.
STOP_WORDS = (
    "the be to of and that have with for is it in a on was by this are from as at or an "
    "der die das und ist ein eine zu den von mit für auf im dem des nicht "
    "le la les de des et un une est que dans pour du en au sur par "
    "el los las y que del se por con una su para es no lo"
).split()


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule when its ``measure`` is below ``low`` or above
    ``high`` and it has ``min_words`` words at least."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


RULES = (
    Rule("too_few_words", "n_words", low=10),
    Rule("mean_word_length", "mean_word_length", low=2.0, high=14.0),
    Rule("symbols_to_words", "symbol_ratio", high=0.3),
    Rule("few_letter_words", "letter_word_ratio", low=0.6),
    Rule("no_stop_words", "stop_ratio", low=0.01, min_words=80),
    Rule("shouting", "upper_ratio", high=0.5, min_words=10),
    Rule("exclamations", "bang_ratio", high=0.3),
    Rule("bullet_lines", "bullet_line_ratio", high=0.9),
    Rule("ellipsis_lines", "ellipsis_line_ratio", high=0.3),
    Rule("duplicate_lines", "dup_line_ratio", high=0.3),
    Rule("repeated_windows", "repeat_ratio", high=0.2),
    Rule("same_word_again", "top_run_ratio", high=0.2, min_words=20),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _removed(text: Column, chars: str) -> Column:
    """Characters of ``text`` that are in ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _left(text: Column, removed: str) -> Column:
    """Characters of ``text`` that stay when runs of ``removed`` go."""
    return F.length(F.regexp_replace(text, removed, "")).cast("long")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_RE), "")


def _either(words: list[str]) -> str:
    """Pattern of any of ``words``, which branches at each letter once."""
    heads = dict.fromkeys(w[0] for w in words if w)
    branches = [h + _either([w[1:] for w in words if w[:1] == h]) for h in heads]
    if not branches:
        return ""
    return "(?:" + "|".join(branches) + ")" + ("?" if "" in words else "")


def repeated_words(words: Column, n: int = WINDOW) -> Column:
    """Words in n-word windows that the text holds twice or more, the first
    included. Windows are compared by a 64-bit hash of their words; only texts
    with some equal windows are sorted."""
    size = F.size(words)
    starts = F.sequence(F.lit(0), size - n)
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(n))))

    def covered(h: Column) -> Column:
        # Equal windows stand side by side after the sort; their starts in order, each covers up to the next start.
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(o: Column) -> Column:
            last = F.size(o) - 1
            return F.filter(o, lambda x, j: ((j > 0) & (F.get(o, j - 1)["h"] == x["h"])) | ((j < last) & (F.get(o, j + 1)["h"] == x["h"])))
        at = _let(_let(order, twice), lambda t: F.sort_array(F.transform(t, lambda x: x["i"])))
        return _let(at, lambda a: F.aggregate(F.transform(a, lambda x, j: F.least(F.lit(n), F.coalesce(F.get(a, j + 1) - x, F.lit(n)))), F.lit(0), lambda s, x: s + x))

    some = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(size < n + 1, F.lit(0)).otherwise(some).cast("long")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once: a one-element transform binds it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measures(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its measures, and the columns' names by measure (chosen so
    that they clash with no column of ``docs``)."""
    text, words, lines = fresh(docs, "text", "words", "lines")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop", "n_letter_words", "n_upper", "n_letters", "n_bang", "n_bullet", "n_ellipsis", "n_again"]
    col = dict(zip(names, fresh(docs, *names), strict=True))
    t, w, ln = F.col(text), F.col(words), F.col(lines)
    df = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumn(words, words_of(t)).withColumn(lines, F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0))
    n_lines = F.size(ln).cast("long")
    values = {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
        "n_symbols": _removed(t, SYMBOLS),
        "n_dup_lines": n_lines - F.size(F.array_distinct(ln)),
        "n_repeat_words": repeated_words(w),
        "n_lines": n_lines,
        "n_stop": F.regexp_count(F.lower(t), F.lit(r"(?<!\p{L})" + _either(list(dict.fromkeys(STOP_WORDS))) + r"(?!\p{L})")).cast("long"),
        "n_letter_words": F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*")).cast("long"),
        "n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
        "n_letters": _left(t, r"\P{L}+"),
        "n_bang": _removed(t, "!?"),
        "n_bullet": F.size(F.filter(ln, lambda x: x.rlike(r"^\s*[-*•·–]"))).cast("long"),
        "n_ellipsis": F.size(F.filter(ln, lambda x: x.rlike(r"(?:\.\.\.|…)\s*$"))).cast("long"),
        "n_again": F.size(F.filter(w, lambda x, i: (i > 0) & (F.get(w, i - 1) == x))).cast("long"),
    }
    return df.select(*(F.col(f"`{c}`") for c in docs.columns), *(v.alias(col[k]) for k, v in values.items())), col


def ratios(c: dict[str, str]) -> dict[str, Column]:
    """The measures that rules speak of, over the columns of ``measures``."""
    m = {k: F.col(v).cast("double") for k, v in c.items()}
    return {
        "n_words": m["n_words"],
        "mean_word_length": _ratio(m["word_chars"], m["n_words"]),
        "symbol_ratio": _ratio(m["n_symbols"], m["n_words"]),
        "letter_word_ratio": _ratio(m["n_letter_words"], m["n_words"]),
        "stop_ratio": _ratio(m["n_stop"], m["n_words"]),
        "upper_ratio": _ratio(m["n_upper"], m["n_letters"]),
        "bang_ratio": _ratio(m["n_bang"], m["n_words"]),
        "bullet_line_ratio": _ratio(m["n_bullet"], m["n_lines"]),
        "ellipsis_line_ratio": _ratio(m["n_ellipsis"], m["n_lines"]),
        "dup_line_ratio": _ratio(m["n_dup_lines"], m["n_lines"]),
        "repeat_ratio": _ratio(m["n_repeat_words"], m["n_words"]),
        "top_run_ratio": _ratio(m["n_again"], m["n_words"]),
    }


def failures(c: dict[str, str], rules: tuple[Rule, ...] = RULES) -> Column:
    """Array of the names of the rules that a row breaks, in the table's order."""
    value = ratios(c)
    broken = []
    for r in rules:
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (value[r.measure] < r.low)
        if r.high is not None:
            bad = bad | (value[r.measure] > r.high)
        broken.append(F.when(bad & (value["n_words"] >= r.min_words), F.lit(r.name)))
    return F.array_compact(F.array(*broken))


def judge(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with counts, ``base_failed``, ``failed_rules`` and ``kept``.
    Columns of ``docs`` with these names are replaced.

    A null text counts as empty; texts without words fail for their length;
    texts of any length are measured whole; rows are judged alone, so
    repeated rows get equal verdicts, and an empty table gives no rows."""
    df, c = measures(docs, text_col)
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    base = (F.col(c["n_words"]) < 10) | (100 * F.col(c["n_repeat_words"]) > 20 * F.col(c["n_words"]))
    added = {"base_failed": base, "failed_rules": failures(c, rules)}
    kept = [F.col(f"`{x}`") for x in docs.columns if x.lower() not in {*shown, *added, "kept"}]
    out = df.select(*kept, *(F.col(c[x]).alias(x) for x in shown), *(v.alias(k) for k, v in added.items()))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT *, CASE WHEN len(words) < 5 THEN [] ELSE
             list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END AS grams FROM w),
d AS (SELECT *, CASE WHEN len(grams) = len(list_distinct(grams)) THEN [] ELSE grams END AS rep FROM g),
r AS (SELECT doc_id, count(DISTINCT pos + k) AS n FROM (
        SELECT doc_id, unnest(starts) AS pos FROM (
          SELECT doc_id, gram, list(pos) AS starts FROM (
            SELECT doc_id, unnest(rep) AS gram, generate_subscripts(rep, 1) AS pos FROM d) GROUP BY doc_id, gram HAVING count(*) > 1)),
        (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
m AS (SELECT d.doc_id, len(words)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(r.n, 0)::BIGINT AS n_repeat_words, text, words, lines
      FROM d LEFT JOIN r USING (doc_id)),
v AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed, greatest(n_words, 1)::DOUBLE AS nw, greatest(len(lines), 1)::DOUBLE AS nl FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / nw BETWEEN 2 AND 14 AND n_symbols / nw <= 0.3
       AND len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) / nw >= 0.6
       AND (n_words < 80 OR len(regexp_extract_all(regexp_replace(lower(text), '(\p{L}+)', ' \1 ', 'g'), ' (__STOP__) ')) / nw >= 0.01)
       AND len(regexp_extract_all(text, '\p{Lu}')) <= 0.5 * len(regexp_extract_all(text, '\p{L}'))
       AND len(regexp_extract_all(text, '[!?]')) / nw <= 0.3
       AND len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•·–]'))) / nl <= 0.9
       AND len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) / nl <= 0.3
       AND n_dup_lines / nl <= 0.3
       AND (n_words < 20 OR len(list_filter(range(2, n_words + 1), lambda i: words[i] = words[i - 1])) / nw <= 0.2) AS kept
FROM v
""".replace("__STOP__", "|".join(dict.fromkeys(STOP_WORDS)))
