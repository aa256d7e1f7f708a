"""Main text of web pages by wrapper induction.

Every page becomes a DOM tree. One distinct page of each host is its pivot;
all other pages of the host are aligned with it by simple tree matching; those that
match it poorly have another layout and get a pivot of their own, and so on. The
text nodes of a pivot that most pages of its layout repeat word for word are the
template. A page's text is what stands in its varying slots, outside elements
whose role (navigation, adverts, forms, comments ...) is never article text.

Pages are compared as skeletons (tags, depths and text hashes), so alignment
shuffles little; exact copies of a page count once. A hot host is dealt out in
chunks, each with its own copy of the pivot. Only hosts with a template take
part in the final join."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from math import isqrt

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint
from .url_filters import host_of

#: A pivot text is template if this share of the host's distinct pages repeat it, of ``MIN_PAGES`` at least.
CONSTANT, MIN_PAGES = 0.6, 3
#: A page has a pivot's layout if this share of the smaller tree's nodes match; LAYOUTS pivots of a host at most.
FITS, LAYOUTS = 0.5, 4
#: Pages of a host that share one copy of its pivot.
CHUNK = 500
#: Elements nested deeper hang on their ancestor at this depth.
MAX_DEPTH = 100
#: Child lists with up to this many cells are aligned in one table; of longer ones' table few rows are held at a time, with the same result.
CELLS = 250_000
TEXT = "#"

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
NO_TEXT = frozenset("head title script style noscript template iframe object svg canvas nav header footer aside button select textarea input option dialog menu".split())
#: Start and end tags of page parts that an author may forget to close.
PARTS = re.compile(r"<(/?(?:nav|header|footer|aside|menu))\b", re.I)
#: Open elements that a start tag ends, and the elements that bound that.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
ROLE = re.compile(r"ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|popup|modal|newsletter|subscribe|sidebar|side|widget|related|recommend\w*|share|social|breadcrumbs?|nav|navbar|navigation|menu|footer|masthead|comments?|list|replies|disqus|pagination|pager|login|signup|copyright|legal", re.I)
ROLES = frozenset("navigation banner contentinfo complementary menu menubar".split())
#: Roles that can stand round a whole page: like classes and ids, they drop an element only if it isn't what the page is about.
WIDE_ROLES = frozenset("search form dialog alert".split())
#: An element of a role's name with over half of the page's text stays, unless it stands beside an article that
#: has text besides its h1, or in one that has so many characters outside such elements.
PROPER = 500


def has_role(names: str) -> bool:
    """Whether one of the class tokens or the id is made of role words alone
    (sidebar, cookie-notice; not has-sidebar, no-comments, site-legal-news)."""
    for token in names.split():
        parts = [x for x in re.split("[-_]+", token) if x]
        if any(x.lower() != "list" for x in parts) and all(map(ROLE.fullmatch, parts)):
            return True
    return False


@dataclass
class Tree:
    """Nodes in page order: depth, label, text (text nodes), hash of the text, number of nodes below and itself, hash of the shape."""

    depth: list[int] = field(default_factory=list)
    label: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    digest: list[int] = field(default_factory=list)
    size: list[int] = field(default_factory=list)
    shape: list[int] = field(default_factory=list)

    def add(self, depth: int, label: str, text: str = "", digest: int = 0) -> None:
        self.depth.append(depth)
        self.label.append(label)
        self.text.append(text)
        self.digest.append(digest)

    def close(self) -> Tree:
        """Sizes and shapes, from the last node back."""
        n = len(self.depth)
        self.size, self.shape = [1] * n, [0] * n
        for i in reversed(range(n)):
            kids = self.children(i)
            self.size[i] += sum(self.size[k] for k in kids)
            self.shape[i] = hash((self.label[i], *(self.shape[k] for k in kids)))
        return self

    def children(self, i: int) -> list[int]:
        out, k, end = [], i + 1, len(self.depth)
        while k < end and self.depth[k] > self.depth[i]:
            out.append(k)
            k += self.size[k]
        return out

    def skeleton(self) -> str:
        return json.dumps([self.depth, self.label, self.digest], separators=(",", ":"))

    @staticmethod
    def of_skeleton(s: str) -> Tree:
        d, label, h = json.loads(s)
        return Tree(d, label, [""] * len(d), h).close()


class _Parser(HTMLParser):
    """Tree of the elements that may hold article text. Elements named like a
    role are candidates: whether they are dropped is decided when the page is read."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack, self.skip, self.run = [], 0, []
        self.raw: list[tuple[int, str, int, list[tuple[int, str]]]] = []  # depth, label, innermost candidate, pieces of text
        # By candidate (0: the page): the one around it, whether it holds an article, main or h1, characters of its own.
        self.around, self.holds, self.chars, self.candidate = [0], [True], [0], 0
        self.within, self.inside, self.title, self.proper = [False], 0, 0, 0
        self.unclosed: set[str] = set()

    def flush(self) -> None:
        if any(not x.isspace() for _, x in self.run):
            self.raw.append((min(len(self.stack), MAX_DEPTH) + 1, TEXT, 0, self.run))
        self.run = []

    def pop(self, k: int) -> None:
        """Close all open elements from the k-th on."""
        for tag, dropped, candidate in reversed(self.stack[k:]):
            if not self.skip and tag in BLOCKS:
                self.flush()
            self.skip -= dropped
            self.inside -= tag in ("article", "main")
            self.title -= tag == "h1"
            if candidate:
                self.candidate = self.around[candidate]
        del self.stack[k:]

    def parse_html_declaration(self, i: int) -> int:
        """Marked sections that HTML doesn't know are comments up to the next ``>``."""
        if self.rawdata.startswith("<![", i) and not self.rawdata.startswith("<![CDATA[", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def _recover(self) -> None:
        """An article or main begins: elements around it that are dropped by their tag
        end here if the page doesn't close all of their kind."""
        dropped = [k for k, (_, drop, _) in enumerate(self.stack) if drop]
        if dropped and all(self.stack[k][0] in self.unclosed for k in dropped):
            self.pop(dropped[0])

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.skip and tag in ("article", "main"):
            self._recover()
        if tag in VOID:
            if not self.skip:
                self.flush() if tag == "hr" else self.run.append((self.candidate, " "))
            return
        if tag in BLOCKS:
            if not self.skip:
                self.flush()
            self._end("p", "button")
        if tag in ENDS:
            for t in ENDS[tag][0].split():
                self._end(t, ENDS[tag][1])
        a = dict(attrs)
        main = tag in ("html", "body", "article", "main", "h1")
        role = has_role(f"{a.get('class') or ''} {a.get('id') or ''}")
        drop = tag in NO_TEXT or (a.get("role") or "").lower() in ROLES
        # An article's own header holds its title.
        if tag == "header" and any(t in ("article", "main") for t, *_ in self.stack) and not role:
            drop = False
        candidate = 0
        if not self.skip and not drop:
            if tag in ("article", "main", "h1"):
                k = self.candidate
                while not self.holds[k]:
                    self.holds[k], k = True, self.around[k]
            if tag == "form" or not main and role or (a.get("role") or "").lower() in WIDE_ROLES or "hidden" in a:
                candidate = len(self.around)
                self.around.append(self.candidate)
                self.holds.append(tag in ("article", "main", "h1"))
                self.chars.append(0)
                self.within.append(self.inside > 0)
                self.candidate = candidate
            if tag in BLOCKS:
                self.raw.append((min(len(self.stack), MAX_DEPTH) + 1, tag, self.candidate, []))
        self.stack.append((tag, drop, candidate))
        self.skip += drop
        self.inside += tag in ("article", "main")
        self.title += tag == "h1"

    def tree(self) -> Tree:
        """Nodes outside dropped elements."""
        n = len(self.around)
        for k in range(n - 1, 0, -1):
            self.chars[self.around[k]] += self.chars[k]
        gone = [False] * n
        for k in range(1, n):
            bulk = 2 * self.chars[k] > self.chars[0] and self.proper < (PROPER if self.within[k] else 1)
            gone[k] = gone[self.around[k]] or not self.holds[k] and not bulk
        out = Tree()
        out.add(0, "root")
        for depth, label, candidate, pieces in self.raw:
            if label != TEXT:
                if not gone[candidate]:
                    out.add(depth, label)
            elif text := " ".join("".join(x for k, x in pieces if not gone[k]).split()):
                out.add(depth, TEXT, text, xxhash.xxh64_intdigest(text) >> 11)
        return out

    def _end(self, tag: str, bounds: str) -> None:
        stop = {*bounds.split(), "article", "main", "section", "div", "body", "table", "td"} - {tag}
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                return self.pop(k)
            if self.stack[k][0] in stop:
                return None
        return None

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                return self.pop(k)
        return None

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.run.append((self.candidate, data))
            n = sum(map(len, data.split()))
            self.chars[self.candidate] += n
            if self.inside and not self.title and not self.candidate:
                self.proper += n


def unclosed(html: str) -> set[str]:
    """Page parts (``PARTS``) of which the page has more start than end tags."""
    seen = Counter(x.lower() for x in PARTS.findall(html))
    return {tag for tag in seen if tag[0] != "/" and seen[tag] > seen[f"/{tag}"]}


def parse(html: str | None) -> Tree:
    """Tree of a page; null, empty and broken pages give what can be read."""
    p = _Parser()
    p.unclosed = unclosed(html or "")
    p.feed(html or "")
    p.close()
    p.pop(0)
    p.flush()
    t = p.tree()
    # Inline elements aren't nodes: depths close up so that a child is one below its parent.
    open_, depth = [], []
    for d in t.depth:
        while open_ and open_[-1] >= d:
            open_.pop()
        open_.append(d)
        depth.append(len(open_) - 1)
    t.depth = depth
    return t.close()


def match(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Node pairs of the largest order-keeping top-down match of two trees
    (simple tree matching); among equals, the one with more equal texts."""
    memo: dict[tuple[int, int], tuple[float, list[tuple[int, int]]]] = {}

    def same(i: int, j: int) -> tuple[float, list[tuple[int, int]]]:
        n = a.size[i]
        return n + 0.5 * sum(a.digest[i + k] == b.digest[j + k] != 0 for k in range(n)), [(i + k, j + k) for k in range(n)]

    def best(i: int, j: int) -> tuple[float, list[tuple[int, int]]]:
        if a.label[i] != b.label[j]:
            return 0.0, []
        if (i, j) not in memo:
            memo[i, j] = same(i, j) if a.shape[i] == b.shape[j] else lists(i, j)
        return memo[i, j]

    def lists(i: int, j: int) -> tuple[float, list[tuple[int, int]]]:
        x, y = a.children(i), b.children(j)
        total, pairs = align(x, y) if len(x) * len(y) <= CELLS else trimmed(x, y)
        return total + 1.0, [(i, j), *pairs]

    def key(t: Tree, u: int) -> tuple:
        return t.shape[u], *t.digest[u:u + t.size[u]]

    def trimmed(x: list[int], y: list[int]) -> tuple[float, list[tuple[int, int]]]:
        """A long list's best match: equal subtrees at the beginning and the end belong to each other (no other
        partner gives more), what is left between them is aligned."""
        low, n = 0, min(len(x), len(y))
        while low < n and key(a, x[low]) == key(b, y[low]):
            low += 1
        tail = 0
        while tail < n - low and key(a, x[-1 - tail]) == key(b, y[-1 - tail]):
            tail += 1
        ex, ey = len(x) - tail, len(y) - tail
        u, v = x[low:ex], y[low:ey]
        parts = [*map(same, x[:low], y[:low]), align(u, v) if len(u) * len(v) <= CELLS else align_long(u, v), *map(same, x[ex:], y[ey:])]
        return sum(s for s, _ in parts), [p for _, pairs in parts for p in pairs]

    def align_long(x: list[int], y: list[int]) -> tuple[float, list[tuple[int, int]]]:
        """``align`` row by row. Only every few rows of the table are held; the way back makes those between anew."""
        alike: dict[int, list[int]] = {}
        for c, v in enumerate(y):
            alike.setdefault(b.shape[v], []).append(c)
        groups = {shape: (np.array(at), np.array([b.digest[y[c]:y[c] + b.size[y[c]]] for c in at])) for shape, at in alike.items()}
        texts = [frozenset(b.digest[v:v + b.size[v]]) - {0} for v in y]
        scores: dict[tuple, float] = {}
        rows: dict[tuple, np.ndarray] = {}

        def weights(u: int) -> np.ndarray:
            """Scores of u with each of y. Trees of other shapes that share the same texts in the same places score alike."""
            k = key(a, u)
            if k in rows:
                return rows[k]
            out, mine = np.zeros(len(y)), a.digest[u:u + a.size[u]]
            own = frozenset(mine) - {0}
            for shape, (at, digests) in groups.items():
                if a.label[u] != b.label[y[at[0]]]:
                    continue
                if shape == a.shape[u]:
                    out[at] = a.size[u] + 0.5 * ((digests == np.array(mine)) & (digests != 0)).sum(axis=1)
                    continue
                for c in at:
                    both = own & texts[c]
                    v = y[c]
                    kind = (a.shape[u], shape, *((tuple(d if d in both else 0 for d in mine), tuple(d if d in both else 0 for d in b.digest[v:v + b.size[v]])) if both else ()))
                    if kind not in scores:
                        if len(scores) > CELLS:
                            scores.clear()
                        scores[kind] = best(u, v)[0]
                        memo.clear()
                    out[c] = scores[kind]
            if len(rows) > 64:
                rows.clear()
            rows[k] = out
            return out

        def following(row: np.ndarray, u: int) -> np.ndarray:
            return np.r_[0.0, np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weights(u)))]

        step = isqrt(len(x)) + 1
        row, held = np.zeros(len(y) + 1), []
        for r, u in enumerate(x):
            if r % step == 0:
                held.append(row)
            row = following(row, u)
        pairs: list[tuple[int, int]] = []
        total, c = float(row[-1]), len(y)
        for low in range((len(held) - 1) * step, -1, -step):
            block = [held.pop()]
            for u in x[low:low + step]:
                block.append(following(block[-1], u))
            for r in range(len(block) - 1, 0, -1):
                up, here = block[r - 1], block[r]
                while c and here[c] != up[c]:
                    c -= 1
                    if here[c + 1] != here[c]:
                        pairs += best(x[low + r - 1], y[c])[1]
                        break
        return total, pairs

    def align(x: list[int], y: list[int]) -> tuple[float, list[tuple[int, int]]]:
        pairs: list[tuple[int, int]] = []
        m = [[0.0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for r, u in enumerate(x, 1):
            for c, v in enumerate(y, 1):
                m[r][c] = max(m[r - 1][c], m[r][c - 1], m[r - 1][c - 1] + best(u, v)[0])
        r, c = len(x), len(y)
        while r and c:
            if m[r][c] == m[r - 1][c]:
                r -= 1
            elif m[r][c] == m[r][c - 1]:
                c -= 1
            else:
                pairs += best(x[r - 1], y[c - 1])[1]
                r, c = r - 1, c - 1
        return m[len(x)][len(y)], pairs

    return best(0, 0)[1]


def fits(pairs: list[tuple[int, int]], a: Tree, b: Tree) -> bool:
    """Whether two trees with these matching nodes are of one layout."""
    return len(pairs) >= FITS * min(len(a.depth), len(b.depth))


def content(tree: Tree, layouts: list[tuple[Tree, frozenset[int]]] = ()) -> str:
    """Texts of a page in order, without those aligned with a constant text of
    its layout's pivot (the first that fits) that they repeat."""
    template: set[int] = set()
    for pivot, constant in layouts:
        pairs = match(tree, pivot)
        if fits(pairs, tree, pivot):
            template = {i for i, j in pairs if j in constant and tree.digest[i] == pivot.digest[j]}
            break
    return "\n".join(t for i, t in enumerate(tree.text) if t and i not in template)


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, layouts): hosts' pivot skeletons in order, each with the numbers of its template texts; hosts without any have no row."""
    def skeletons(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"host": pdf["host"], "sk": [parse(h).skeleton() for h in pdf["html"]]})

    def repeats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Counts of repeated pivot texts (node) and of pages of the pivot's layout (node -1); skeletons of the others (node -2)."""
        trees: dict[str, Tree] = {}
        for pdf in batches:
            seen: dict[tuple[str, int], int] = {}
            others = []
            for host, sk, pivot in zip(pdf["host"], pdf["sk"], pdf["pivot"], strict=True):
                if host not in trees:
                    if len(trees) > 64:
                        trees.clear()
                    trees[host] = Tree.of_skeleton(pivot)
                b, a = trees[host], Tree.of_skeleton(sk)
                pairs = match(a, b)
                if not fits(pairs, a, b):
                    others.append((host, -2, 1, sk))
                    continue
                seen[host, -1] = seen.get((host, -1), 0) + 1
                for i, j in pairs:
                    if a.digest[i] and a.digest[i] == b.digest[j]:
                        seen[host, j] = seen.get((host, j), 0) + 1
            yield pd.DataFrame([(*k, n, None) for k, n in seen.items()] + others, columns=["host", "node", "n", "sk"]).astype({"node": int, "n": int})

    src = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    rest = checkpoint(src.mapInPandas(skeletons, "host string, sk string").distinct().withColumn("h", F.xxhash64("sk")))
    layouts = None
    for k in range(LAYOUTS):
        pivots = rest.groupBy("host").agg(F.min("h").alias("h"), F.count("*").alias("pages")).where(F.col("pages") >= MIN_PAGES)
        chunks = F.ceil(F.col("pages") / CHUNK).cast("int")
        pivots = checkpoint(rest.join(pivots, ["host", "h"]).dropDuplicates(["host"]).select("host", F.col("sk").alias("pivot"), chunks.alias("chunks")))
        copies = pivots.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        dealt = rest.join(pivots.select("host", "chunks"), "host").withColumn("chunk", F.pmod("h", "chunks").cast("int")).drop("chunks", "h")
        judged = dealt.join(copies.select("host", "chunk", "pivot"), ["host", "chunk"]).select("host", "sk", "pivot").mapInPandas(repeats, "host string, node int, n long, sk string")
        judged = checkpoint(judged)
        counted = judged.where("node >= -1").groupBy("host", "node").agg(F.sum("n").alias("n"))
        sizes = counted.where((F.col("node") == -1) & (F.col("n") >= MIN_PAGES)).select("host", F.col("n").alias("pages"))
        found = counted.where("node >= 0").join(sizes, "host").where(F.col("n") >= CONSTANT * F.col("pages"))
        found = found.groupBy("host").agg(F.sort_array(F.collect_list("node")).alias("constant"))  # a pivot's texts at most
        none = F.array().cast("array<int>")
        layout = pivots.join(found, "host", "left").select("host", F.struct(F.lit(k).alias("k"), "pivot", F.coalesce("constant", none).alias("constant")).alias("layout"))
        layouts = layout if layouts is None else layouts.unionByName(layout)
        rest = judged.where("node = -2").select("host", "sk").withColumn("h", F.xxhash64("sk"))
        if rest.isEmpty():
            break
    layouts = layouts.groupBy("host").agg(F.sort_array(F.collect_list("layout")).alias("layouts"))  # LAYOUTS at most
    return checkpoint(layouts.where(F.exists("layouts", lambda x: F.size(x["constant"]) > 0)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row (id, url, text, n_chars) per row of ``pages``, others columns
    left out. Null, empty and text-free pages give an empty text; pages without
    a host (null url) form one host; repeated rows each keep a row; an empty
    table gives no rows; very long pages are read whole."""
    wrappers = templates(pages, url_col, html_col)
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    # No hint: Spark broadcasts the templates if they are small and else splits skewed hosts.
    joined = src.join(wrappers, "host", "left").select("id", "url", "html", "layouts")

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees: dict[str, Tree] = {}

        def tree(pivot: str) -> Tree:
            if pivot not in trees:
                if len(trees) > 64:
                    trees.clear()
                trees[pivot] = Tree.of_skeleton(pivot)
            return trees[pivot]
        for pdf in batches:
            out = []
            for html, layouts in zip(pdf["html"], pdf["layouts"], strict=True):
                known = [] if layouts is None or isinstance(layouts, float) else layouts
                out.append(content(parse(html), [(tree(x["pivot"]), frozenset(map(int, x["constant"]))) for x in known]))
            yield pd.DataFrame({"id": pdf["id"], "url": pdf["url"], "text": out})

    kind = dict(src.dtypes)["id"]
    done = joined.mapInPandas(texts, f"id {kind}, url string, text string")
    return done.select(F.col("id").alias(id_col), "url", "text", n_chars(F.col("text")))


def n_chars(text: Column) -> Column:
    return F.length(text).cast("long").alias("n_chars")
