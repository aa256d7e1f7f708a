"""URL filters by a path-template tree.

Rules (host, path) come first; the longest that fits decides. All other urls are
judged by the template of their path: per host, level by level, segments that
look like numbers or hashes, or that are rare among many siblings, become
wildcards. Sibling templates whose labelled shares do not differ more than
chance allows are merged, and a template is rejected if its smoothed share of bad
labels is above one half. Labels are the given ones, or else the verdicts of the
rules. All steps are joins and partial aggregations over distinct paths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

#: Levels of the tree; what lies deeper is one wildcard.
DEPTH = 5
#: A node keeps its literal children while it has this many at most; beyond it, those with this share of its urls.
LITERALS, SHARE = 8, 0.05
#: Smoothing weight of the global bad share, labels that a rejection needs, and the width of a chance difference.
STRENGTH, MIN_LABELS, Z = 4.0, 5, 1.64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def templates(paths: DataFrame) -> DataFrame:
    """``paths`` (host, path, n, labelled, bad) with the ``template`` of each path."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    shape = lambda s: F.when(s.rlike(r"^\d+(\.\w{1,5})?$"), "<n>").when(s.rlike(r"^[0-9a-fA-F-]{8,}$"), "<x>").otherwise(s)
    tree = paths.withColumn("seg", F.transform(segments, shape)).withColumn("template", F.lit(""))
    for d in range(DEPTH):
        tree = tree.withColumn("child", F.get("seg", F.lit(d)))
        counts = tree.where("child IS NOT NULL").groupBy("host", "template", "child").agg(F.sum("n").alias("c"))
        nodes = counts.groupBy("host", "template").agg(F.count("*").alias("k"), F.sum("c").alias("total"))
        kept = counts.join(nodes, ["host", "template"]).where((F.col("k") <= LITERALS) | (F.col("c") >= SHARE * F.col("total")))
        kept = kept.select("host", "template", "child", F.lit(True).alias("literal"))
        label = F.when(F.col("child").isNull(), "").when(F.col("literal"), F.concat(F.lit("/"), "child")).otherwise("/*")
        tree = checkpoint(tree.join(kept, ["host", "template", "child"], "left").withColumn("template", F.concat("template", label)).drop("literal", "child"))
    deeper = F.when(F.size("seg") > DEPTH, "/**").otherwise("")
    return tree.withColumn("template", F.concat("template", deeper)).drop("seg")


def rejected(tree: DataFrame) -> DataFrame:
    """(host, template) of templates whose smoothed purity, after merging similar siblings, is too low."""
    node = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).where("labelled > 0")
    node = checkpoint(node.withColumn("kin", F.regexp_replace("template", r"/[^/<*]+", "/*")))
    p0 = F.coalesce(node.agg((F.sum("bad") / F.sum("labelled")).alias("p")).scalar(), F.lit(0.5))
    pool = node.groupBy("host", "kin").agg(F.sum("labelled").alias("pl"), F.sum("bad").alias("pb"))
    rate = F.col("pb") / F.col("pl")
    width = Z * F.sqrt(rate * (1 - rate) / F.col("labelled")) + 1e-9
    node = node.join(pool, ["host", "kin"]).withColumn("alike", F.abs(F.col("bad") / F.col("labelled") - rate) <= width)
    merged = node.where("alike").groupBy("host", "kin").agg(F.sum("labelled").alias("ml"), F.sum("bad").alias("mb"))
    node = node.join(merged, ["host", "kin"], "left")
    n, b = (F.when(F.col("alike"), F.col(m)).otherwise(F.col(own)) for m, own in (("ml", "labelled"), ("mb", "bad")))
    return node.where((n >= MIN_LABELS) & ((b + STRENGTH * p0) / (n + STRENGTH) > 0.5)).select("host", "template")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row (id, host, path, rule, verdict) per row of ``pages``; other
    columns are left out. ``labels``: (host, path, bad boolean), in place of the rules' verdicts.

    Null urls and urls without ``://`` have an empty host and path and no rule;
    repeated rows each keep a row; an empty table gives no rows."""
    split = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    split = split.withColumn("rule", name).withColumn("given", verdict)
    bad = F.when(F.col("given").isNotNull(), (F.col("given") == "block").cast("long"))
    if labels is None:
        paths = split.groupBy("host", "path").agg(F.count("*").alias("n"), F.count(bad).alias("labelled"), F.coalesce(F.sum(bad), F.lit(0)).alias("bad"))
    else:
        known = labels.groupBy("host", "path").agg(F.count("bad").alias("labelled"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"))
        paths = split.groupBy("host", "path").agg(F.count("*").alias("n")).join(known, ["host", "path"], "left").fillna(0, ["labelled", "bad"])
    tree = templates(checkpoint(paths))
    gone = tree.join(rejected(tree), ["host", "template"], "left_semi").select("host", "path", F.lit("block").alias("found"))
    # Only urls that no rule judges need the template's verdict.
    return split.join(gone, ["host", "path"], "left").select(id_col, "host", "path", "rule", F.coalesce("given", "found", F.lit("allow")).alias("verdict"))
