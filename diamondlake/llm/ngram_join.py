"""Documents whose word n-gram sets are alike, by vertical partitioning.

A text's set holds 64-bit hashes of its n-grams; equal sets form a class and
take part once. With a Jaccard similarity of t, two sets of n and m grams share
at least t * max(n, m) of them. The join goes in three steps, all exact:

1. Prefixes by hash value. Of two alike sets with k grams allowed to miss, the
   first l common grams lie among the first k + l of either. A class of which
   fewer prefix grams stand in any other class's prefix than that has no
   partner. Most classes end here, with a fifth of their grams shuffled.
2. Candidates. The grams left get their frequency, and (frequency, hash) is the
   global order. Classes whose prefixes in that order share a gram are
   candidates. Each bucket first offers its most central class as partner for
   all others; pairs within a component that these links join aren't looked at
   any more. Others are found by what distinguishes them from their centre.
3. Partial overlaps. The global order is cut into fragments of equal load, each
   set into a segment for each fragment. A candidate pair's segments meet
   fragment by fragment, and the partial overlaps are summed per pair.

Families of copies of any size thus need links to their centre, not all their pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, prepare
from .graph import components

#: Parts of the global order.
FRAGMENTS = 8
#: Rows (16 bytes each) of the one table that may be broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 1 << 20
#: Factors that mix the hashes of a gram's words (odd numbers; fixed values).
MIX, FINISH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def gram_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams. Words are what ASCII white
    space separates, A-Z lower-cased; fewer words than ``size`` make one gram, no words none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(size, len(words))
    grams = np.zeros(len(words) - width + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            grams = grams * MIX + hashes[k:k + len(grams)]
        grams = (grams ^ (grams >> np.uint64(32))) * FINISH
    return np.unique(grams ^ (grams >> np.uint64(29)))


def need(n: int, num: int, den: int) -> int:
    """Least overlap of a set of n grams with any partner."""
    return -(-num * n // den)


def lead(n: int, num: int, den: int) -> int:
    """How many common grams the prefix by hash value is to hold."""
    return max(1, min(n - need(n, num, den), need(n, num, den)))


def prefix(n: int, num: int, den: int) -> int:
    """Length of the prefix by hash value; 0 where no other size and no other set of this size can be alike."""
    missed = n - need(n, num, den)
    return missed + lead(n, num, den) if missed or n * den // num > n else 0


def _set_id(grams: np.ndarray) -> str | None:
    return xxhash.xxh3_128_hexdigest(grams.tobytes()) if len(grams) else None


def _heads(size: int, num: int, den: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [gram_set(t, size) for t in b["text"]]
            heads = [s[:prefix(len(s), num, den)].view(np.int64) for s in sets]
            least = [lead(need(len(s), num, den), num, den) for s in sets]
            yield b[["id", "th"]].assign(n=[len(s) for s in sets], set_id=[_set_id(s) for s in sets], head=heads, least=least)
    return of


def _whole(size: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [gram_set(t, size) for t in b["text"]]
            yield pd.DataFrame({"set_id": [_set_id(s) for s in sets], "n": [len(s) for s in sets], "grams": [s.view(np.int64) for s in sets]})
    return of


#: Frequencies from here on share a level of the global order.
LEVELS = 32767


def place(g: Column) -> Column:
    """A gram's place (struct of df and gram) in the global order, as a long: level of frequency, then hash."""
    return F.shiftleft(F.least(g["df"], F.lit(LEVELS).cast("long")), 48) + F.shiftrightunsigned(g["gram"], 16)


def cuts(often: DataFrame) -> list[int]:
    """Places that cut the global order into fragments of equal load. Hashes are
    even within a level, so the levels' loads (at most ``LEVELS`` rows) are enough."""
    loads = sorted(often.groupBy(F.least("df", F.lit(LEVELS)).alias("level")).agg(F.sum("df")).collect())
    total, sofar, out = sum(x[1] for x in loads), 0, []
    for level, load in loads:
        while len(out) + 1 < FRAGMENTS and (len(out) + 1) * total <= (sofar + load) * FRAGMENTS:
            share = ((len(out) + 1) * total / FRAGMENTS - sofar) / load
            out.append((level << 48) + min(int(share * (1 << 48)), (1 << 48) - 1))
        sofar += load
    return out


class Join:
    """One join: sets of at least ``num`` / ``den`` Jaccard similarity are linked."""

    def __init__(self, size: int, num: int, den: int) -> None:
        self.size, self.num, self.den = size, num, den

    def need(self, n: Column) -> Column:
        return F.floor((n * self.num + (self.den - 1)) / self.den).cast("long")

    def possible(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes, less the grams that no other class has, can still hold enough in common."""
        least = F.ceil((F.col("n") + F.col("m")) * self.num / (self.num + self.den))
        return pairs.where((F.col("n") - F.col("u") >= least) & (F.col("m") - F.col("v") >= least))

    def rows(self, docs: DataFrame) -> DataFrame:
        """id, th (hash of the text), n, set_id, head, least."""
        kind = docs.schema["id"].dataType.simpleString()
        return docs.mapInPandas(_heads(self.size, self.num, self.den), f"id {kind}, th long, n long, set_id string, head array<long>, least long")

    def promising(self, classes: DataFrame) -> DataFrame:
        """Set ids of the classes with enough prefix grams that stand in other prefixes (column cls is their hash)."""
        grams = classes.select("cls", F.explode("head").alias("gram"))
        often = grams.groupBy("gram").count().where("count > 1").select("gram")
        shared = grams.join(often, "gram", "left_semi").groupBy("cls").count()
        return shared.join(classes.select("cls", "least"), "cls").where("count >= least").select("cls").distinct()

    def ordered(self, sets: DataFrame) -> DataFrame:
        """s, n, u (grams that no other set has), prefix and parts: the other grams of
        each set in the global order, its beginning and its segments by fragment."""
        grams = sets.select("s", F.explode("grams").alias("gram"))
        often = checkpoint(grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1"))
        bounds = [None, *cuts(often), None]
        order = grams.join(often, "gram").groupBy("s").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("order"))
        order = order.join(sets.select("s", "n"), "s").where(F.size("order") >= self.need(F.col("n"))).withColumn("u", F.col("n") - F.size("order"))
        prefix = F.slice("order", 1, (F.col("n") - self.need(F.col("n")) + 1 - F.col("u")).cast("int"))

        def part(lo: int | None, hi: int | None) -> Column:
            def inside(g: Column) -> Column:
                return (F.lit(True) if lo is None else place(g) >= lo) & (F.lit(True) if hi is None else place(g) < hi)
            return F.transform(F.filter("order", inside), lambda g: g["gram"])
        parts = F.array(*(part(lo, hi) for lo, hi in zip(bounds, bounds[1:], strict=False)))
        return order.select("s", "n", "u", F.transform(prefix, lambda g: g["gram"]).alias("prefix"), parts.alias("parts"))

    def buckets(self, order: DataFrame) -> DataFrame:
        """gram, s, n, u for each set under the grams of its prefix; ``level`` is the class of its size."""
        level = F.floor(F.log(F.col("n").cast("double")) / np.log(self.den / self.num)).cast("int")
        return order.select(F.explode("prefix").alias("gram"), "s", "n", "u", level.alias("level"))

    def centred(self, order: DataFrame) -> DataFrame:
        """Each set (s, n, u) with its centres (b, m, v): in each bucket the most central
        set of its size and that of the next smaller one. Alike sets share a centre."""
        buckets = self.buckets(order)
        centre = buckets.groupBy("gram", "level").agg(F.min(F.struct((F.col("u") / F.col("n")).alias("far"), "s", "n", "u")).alias("c"))
        centre = centre.select("gram", F.col("level").alias("at"), F.col("c.s").alias("b"), F.col("c.n").alias("m"), F.col("c.u").alias("v"))
        seen = buckets.withColumn("at", F.explode(F.array("level", F.col("level") - 1))).drop("level")
        return seen.join(centre, ["gram", "at"]).where("s <> b").select("s", "n", "u", "b", "m", "v").distinct()

    def to_centres(self, centred: DataFrame) -> DataFrame:
        """Pairs (a, b) of sets and centres that can be alike."""
        return self.possible(centred).select(F.least("s", "b").alias("a"), F.greatest("s", "b").alias("b")).distinct()

    def rest(self, centred: DataFrame, links: DataFrame, found: DataFrame, order: DataFrame) -> DataFrame:
        """All other pairs (a, b) that can be alike, of sets with a common centre and in
        different components of ``found``.

        Sets are compared through what distinguishes them from the centre c: the
        difference of x and y is that of D(x) = x - c + (c - x) and D(y), so alike sets
        need |D(x) & D(y)| >= (|D(x)| + |D(y)| - d) / 2, d being the difference
        that their sizes allow. At least one of a pair isn't linked to c and has
        more than d in D. So D is searched like the sets, by the prefixes that must
        share a gram; sets that need share none are held against all of their centre."""
        near = links.select(F.col("a").alias("s"), "b").unionByName(links.select(F.col("b").alias("s"), F.col("a").alias("b"))).withColumn("linked", F.lit(True))
        part = centred.join(found.withColumnRenamed("node", "s"), "s", "left").withColumn("comp", F.coalesce("component", "s")).drop("component")
        mixed = part.groupBy("b").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("b")
        part = part.join(mixed, "b").join(near, ["s", "b"], "left").withColumn("few", F.col("linked").isNull()).drop("linked")
        segments = order.select("s", F.posexplode("parts").alias("fragment", "part"))
        both = part.join(segments, "s").join(segments.withColumnsRenamed({"s": "b", "part": "other"}), ["b", "fragment"])
        own = F.array_union(F.array_except("part", "other"), F.array_except("other", "part"))
        parts = both.select("b", "s", "n", "u", "m", "v", "comp", "few", F.struct("fragment", F.sort_array(own).alias("own")).alias("own"))
        delta = parts.groupBy("b", "s", "n", "u", "m", "v", "comp", "few").agg(F.sort_array(F.collect_list("own")).alias("own"))
        delta = delta.withColumn("own", F.flatten(F.transform("own", lambda x: x["own"]))).withColumn("d", F.size("own") + F.col("u"))
        slack = (self.den - self.num) / (self.den + self.num)
        most = F.floor((F.col("n") + F.floor(F.col("n") * self.den / self.num)) * slack)
        least = F.when(F.col("few"), F.col("d") + F.greatest(F.lit(0), F.col("d") - most) - most).otherwise(F.col("d") + F.floor((F.col("m") - F.col("n")) * slack) - 1 - F.col("v"))
        delta = checkpoint(delta.withColumn("share", F.ceil(least / 2)).drop("m", "v"))
        other = delta.withColumnsRenamed({"s": "t", "n": "m", "u": "v", "d": "e", "comp": "comp2", "few": "few2", "own": "own2", "share": "share2"})
        allowed = F.col("n") + F.col("m") - 2 * F.ceil((F.col("n") + F.col("m")) * self.num / (self.num + self.den))
        can = (F.col("comp") != F.col("comp2")) & (~F.col("few2") | (F.col("s") < F.col("t"))) & (2 * F.least(F.col("d") - F.col("u"), F.col("e") - F.col("v")) >= F.col("d") + F.col("e") - allowed)

        def prefix(own: str, d: str, u: str, share: str) -> Column:
            return F.explode(F.slice(own, 1, F.greatest(F.lit(0), F.col(d) - F.col(share) + 1 - F.col(u)).cast("int"))).alias("gram")
        left = delta.where("few AND share > 0").select("b", "s", "n", "u", "d", "comp", prefix("own", "d", "u", "share"))
        right = other.where("share2 > 0").select("b", "t", "m", "v", "e", "comp2", "few2", prefix("own2", "e", "v", "share2"))
        met = left.join(right, ["b", "gram"]).where(can).select("s", "t", "n", "u", "m", "v")
        loose = delta.where("few").drop("own").join(other.drop("own2"), "b").where(((F.col("share") <= 0) | (F.col("share2") <= 0)) & can).select("s", "t", "n", "u", "m", "v")
        return self.possible(met.unionByName(loose)).select(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).distinct()

    def verified(self, pairs: DataFrame, order: DataFrame) -> DataFrame:
        """The pairs whose partial overlaps, counted fragment by fragment, sum up to enough."""
        segments = order.select("s", "n", F.posexplode("parts").alias("fragment", "part")).where(F.size("part") > 0)
        left = pairs.join(segments.withColumnsRenamed({"s": "a", "part": "x"}), "a")
        both = left.join(segments.withColumnsRenamed({"s": "b", "n": "m", "part": "y"}), ["b", "fragment"])
        partial = both.select("a", "b", "n", "m", F.size(F.array_intersect("x", "y")).alias("overlap"))
        total = partial.groupBy("a", "b", "n", "m").agg(F.sum("overlap").alias("overlap"))
        return total.where(F.col("overlap") * (self.num + self.den) >= (F.col("n") + F.col("m")) * self.num).select("a", "b", "overlap", (F.col("n") + F.col("m") - F.col("overlap")).alias("union"))


def near_sets(docs: DataFrame, id_col: str, text_col: str, size: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents, classes and links of a join at Jaccard similarity num / den.

    * rows (id, n, set_id): one per row of ``docs``, with the size of its set and
      the id of its class (null without words);
    * classes (set_id, members, least, s, component, component_id): those of more than
      one row or with a link; number of rows and least id of the class, its number and that of
      its component in ``links`` (null without links), and the least id in the component;
    * links (a, b, overlap, union): of class numbers. They span the components, so
      classes that share a component may have links beyond these.

    Null and empty texts are in no class; repeated rows are rows of one class;
    rows without id take part, and the least id leaves them out. An empty table
    gives empty tables."""
    prepare(docs.sparkSession)
    join = Join(size, num, den)
    text = F.coalesce(F.col(text_col), F.lit(""))
    given = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    rows = checkpoint(join.rows(given))
    some = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(F.count("*").alias("members"), F.min("id").alias("least"), F.min(F.struct("th", "id")).alias("pick"))
    heads = rows.where(F.size("head") > 0).groupBy("set_id").agg(F.first("least").alias("least"), F.first("head").alias("head"))
    promising = join.promising(heads.select(F.xxhash64("set_id").alias("cls"), "least", "head")).withColumn("open", F.lit(True))
    some = checkpoint(some.withColumn("cls", F.xxhash64("set_id")).join(promising, "cls", "left").where("open OR members > 1").drop("cls"))
    links, numbers = _links(join, given, some.where("open").select("pick.*"))
    found = numbers.join(components(links.select("a", "b")).withColumnRenamed("node", "s"), "s")
    classes = some.select("set_id", "members", "least").join(found, "set_id", "left").where("members > 1 OR s IS NOT NULL")
    reached = classes.where("s IS NOT NULL").groupBy("component").agg(F.min("least").alias("reached"))
    classes = classes.join(reached, "component", "left").select("set_id", "members", "least", "s", "component", F.coalesce("reached", "least").alias("component_id"))
    return rows.select("id", "n", "set_id"), classes, links


def _links(join: Join, given: DataFrame, picks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links among the classes of the rows ``picks`` (th, id), and the numbers (s, set_id) of these classes."""
    picks = picks.withColumnsRenamed({"id": "pid", "th": "pth"})
    picks = F.broadcast(picks) if picks.count() <= BROADCAST_ROWS else picks
    texts = given.join(picks, (F.col("th") == F.col("pth")) & F.col("id").eqNullSafe(F.col("pid")), "left_semi")
    sets = texts.select("text").mapInPandas(_whole(join.size), "set_id string, n long, grams array<long>")
    sets = sets.groupBy("set_id").agg(F.first("n").alias("n"), F.first("grams").alias("grams"))
    sets = checkpoint(sets.withColumn("s", F.monotonically_increasing_id()))
    order = checkpoint(join.ordered(sets))
    centred = checkpoint(join.centred(order))
    first = checkpoint(join.verified(join.to_centres(centred), order))
    more = join.rest(centred, first.select("a", "b"), components(first.select("a", "b")), order)
    links = checkpoint(first.unionByName(join.verified(more, order)).distinct())
    return links, sets.select("s", "set_id")


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """One row per row of ``docs``: its id, n (size of its set) and component_id,
    the least id reachable over links and equal sets. A row without words or
    partner has its own id. For a class without any id it is null."""
    rows, classes, _ = near_sets(docs, id_col, text_col, size, num, den)
    # Rows that stand alone need no lookup; the rest is a left join that Spark may split on hot classes.
    out = rows.join(classes.select("set_id", "component_id", F.lit(True).alias("grouped")), "set_id", "left")
    return out.select(F.col("id").alias(id_col), "n", F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
