"""The training-data operators against brute force, hand-made cases and held-out accuracy."""

import random
import re

import pandas as pd
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from diamondlake.llm import decontamination, html_extraction, license_scan, mixing, pu_quality, quality_rules, registry, sharding, simhash_dedup, toxicity, url_filters
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, id string, `__text` string, seg string"
PAGES = "page_id long, url string, html string, host string, text string"
LONG = "word another thing " * 30_000


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "hello there world"), (1, "hello there world"), (2, None), (3, ""), (None, "hello there world"), (4, LONG), (5, " \t\n "), (6, None)]
    return spark.createDataFrame([(i, t, "x", None, "y") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, None), (None, 0, 1), (4, 0, 1)], "doc_id long, quality int, toxic int")


def table(name):
    return pd.read_parquet(f"{SF_SMALL}/{name}.parquet")


# 1 ---------------------------------------------------------------------------

def page(body, n=0):
    return f"<html><head><title>t{n}</title><style>p{{}}</style></head><body><nav><a>Home</a></nav><div class='ad'>buy {n}</div><article><h1>T{n}</h1>{body}</article><div id='comments'>nice {n}</div><footer>f</footer></body></html>"


def test_html_wrapper_and_roles(spark):
    pages = [(k, "http://h.org/a", page(f"<p>Read this first</p><p>story  {k} &amp; more<p>second {k}", k)) for k in range(6)]
    pages += [(9, "http://one.org/", page("<p>Read this first</p>")), (10, None, None), (11, "x", ""), (12, "http://h.org/b", page("<p>story 1 &amp; more"[:-4], 7))]
    df = spark.createDataFrame([(*p, "clash", "clash") for p in pages + pages[:1]], PAGES)
    got = {(r["page_id"]): r for r in html_extraction.extract(df).collect()}
    assert html_extraction.extract(df).count() == len(pages) + 1
    assert got[2]["text"] == "T2\nstory 2 & more\nsecond 2"          # the host's constant line is template
    assert got[9]["text"] == "T0\nRead this first"                    # a lone page has no template
    assert got[10]["text"] == got[11]["text"] == "" and got[10]["n_chars"] == 0
    assert got[2]["n_chars"] == len(got[2]["text"])
    assert html_extraction.extract(df.limit(0)).count() == 0


def test_html_role_names():
    def text(html):
        return html_extraction.content(html_extraction.parse(html))
    story = "<p>one story</p><p>that goes on</p>"
    for name in ("content has-sidebar", "layout with-sidebar", "post no-comments", "main-content side-by-side", "article-legal-news", "sidebar"):
        page_ = f"<body><div class='ad'>buy</div><div class='{name}'><article><h1>T</h1>{story}</article></div><div id='comments'>nice</div></body>"
        assert text(page_) == "T\none story\nthat goes on"
    assert text(f"<body><form><div class='ad'>buy</div><div>{story}</div><select><option>x</select></form></body>") == "one story\nthat goes on"
    assert text(f"<h1>T</h1><div class=widget>{story * 3}</div>").count("\n") == 6      # the bulk of the page
    assert text(f"<div class='post has-ads'>{story}</div><span class=share>tell</span>") == "one story\nthat goes on"
    assert text(f"<p>{'long story ' * 60}</p><div class='cookie-notice'>we use</div><form>mail <input></form><p>a <b class=promo>buy</b> b") == ("long story " * 60).strip() + "\na b"
    assert "nice" not in text(f"<article>{'long story ' * 60}<div id=comments>{'nice ' * 600}</div></article>")


def test_html_odd_declarations_and_unclosed_parts(spark):
    def text(html):
        return html_extraction.content(html_extraction.parse(html))
    story = "<p>one story</p><p>that goes on</p>"
    plain = "one story\nthat goes on"
    for odd in ("<![foo[bar]]>", "<![if IE]>", "<![", "<!", "<!doctype x [", "<![CDATA[x]]>"):
        assert "one story" in text(f"<body><article>{story}</article>{odd}") or odd in ("<![", "<!doctype x [")
        assert isinstance(text(f"{odd}<article>{story}"), str)
    assert text(f"<body><![endif]><article>{story}</article>") == plain
    for part in ("aside", "nav", "menu", "header", "footer"):
        assert text(f"<body><{part}>links<article>{story}</article></body>") == plain
        assert text(f"<body><{part}>links</{part}><{part}>more<main>{story}</main></body>") == plain
        assert "one story" not in text(f"<body><{part}><article>{story}</article></{part}><article><p>the page's own</p></article></body>")
    df = spark.createDataFrame([(1, "http://a.org/", f"<![foo[bar]]><article>{story}</article>")], "page_id long, url string, html string")
    assert html_extraction.extract(df).first()["text"] == plain


def test_html_layouts_and_long_pages(spark):
    pages = [(k, "http://h.org/a", f"<div><p>Old line</p><p>story {k}</p><p>Old end</p></div>") for k in range(6)]
    pages += [(10 + k, "http://h.org/b", f"<table><tr><td>New line<td>tale {k}<td>New end</table>") for k in range(6)]
    pages += [(20 + n, "http://l.org/", "".join(f"<p>{t}</p>" for t in ["Top", *(f"{n} {k}" for k in range(n)), "Close"])) for n in (5, 600, 650, 700, 720)]
    got = {r["page_id"]: r["text"].split("\n") for r in html_extraction.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[k] == [f"story {k}"] and got[10 + k] == [f"tale {k}"] for k in range(6))
    assert all(got[20 + n] == [f"{n} {k}" for k in range(n)] for n in (5, 600, 650, 700, 720))


def brute_match(a, b, i=0, j=0):
    if a.label[i] != b.label[j]:
        return 0
    x, y = a.children(i), b.children(j)
    m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for r in range(1, len(x) + 1):
        for c in range(1, len(y) + 1):
            m[r][c] = max(m[r - 1][c], m[r][c - 1], m[r - 1][c - 1] + brute_match(a, b, x[r - 1], y[c - 1]))
    return 1 + m[-1][-1]


def test_tree_match_against_brute_force():
    rng = random.Random(5)

    def tree(depth=0):
        return "".join(f"<{t}>{tree(depth + 1) if depth < 3 else rng.choice('abc')}</{t}>" for t in rng.choices(["div", "p", "ul", "section"], k=rng.randint(1, 3)))
    for _ in range(60):
        a, b = html_extraction.parse(tree()), html_extraction.parse(tree())
        pairs = html_extraction.match(a, b)
        assert len(pairs) == len(set(pairs)) == brute_match(a, b)
        assert all(a.label[i] == b.label[j] for i, j in pairs)


def test_html_articles_of_the_test_pages(spark):
    import html
    want = {}
    for r in table("pages").itertuples():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want[r.page_id] = "\n".join(b for b in blocks if b)
    assert {r["page_id"]: r["text"] for r in registry.op1_html_extraction(spark, SF_SMALL).collect()} == want


def test_deep_and_long_pages():
    assert html_extraction.content(html_extraction.parse("<div>" * 5000 + "x" + "</div>" * 5000)) == "x"
    assert html_extraction.content(html_extraction.parse("<p>a" * 3000)).count("\n") == 2999


# 2 ---------------------------------------------------------------------------

def test_url_rules(spark):
    urls = {1: "http://X.Example.ORG/en/17?q", 2: "https://example.org/es/1", 3: "http://a.org/", 4: "http://a.org", 5: "ftp://b.com/fr/x#y", 6: "http://b.com/de/", 7: None, 8: "no scheme", 9: "http://notexample.org/es/1", 10: "http://c.net?x=/fr/"}
    df = spark.createDataFrame([(k, u, "", "h", "t") for k, u in urls.items()], PAGES)
    got = {r["page_id"]: tuple(r)[1:] for r in url_filters.judge(df).select("page_id", "host", "path", "rule", "verdict").collect()}
    assert got == {1: ("x.example.org", "/en/17", "example.org/en/1", "block"), 2: ("example.org", "/es/1", "example.org/es/", "block"), 3: ("a.org", "/", "org/", "allow"),
                   4: ("a.org", "", None, "allow"), 5: ("b.com", "/fr/x", "com/fr/", "allow"), 6: ("b.com", "/de/", "com/de/", "block"), 7: ("", "", None, "allow"),
                   8: ("", "", None, "allow"), 9: ("notexample.org", "/es/1", "org/", "allow"), 10: ("c.net", "", None, "allow")}
    assert url_filters.judge(df.limit(0)).count() == 0


def test_url_templates_reject(spark):
    bad = [(k, f"http://s.net/tag/w{chr(97 + k % 26)}{k}x/{k}") for k in range(60)]
    good = [(100 + k, f"http://s.net/news/{k}") for k in range(60)]
    df = spark.createDataFrame([(k, u, "", "h", "t") for k, u in bad + good], PAGES)
    seen = [("s.net", u.split("s.net")[1], k < 60) for k, u in bad[:40] + good[:40]]
    got = {r["page_id"]: r["verdict"] for r in url_filters.judge(df, (), spark.createDataFrame(seen, "host string, path string, bad boolean")).collect()}
    assert got == {k: "block" if k < 60 else "allow" for k in got} and len(got) == 120


# 3 ---------------------------------------------------------------------------

def simple_simhash(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_query_against_brute_force(spark):
    d = table("documents")
    fp = {i: simple_simhash(t) for i, t in zip(d.doc_id, d.text, strict=True)}
    root = {i: i for i in fp}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(fp)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if (fp[a] ^ fp[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in registry.op3_simhash_dedup(spark, SF_SMALL).collect()}
    assert got == {i: (f"{fp[i]:016x}", find(i)) for i in ids}


def test_simhash_links_with_crowded_buckets(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(120)} | {rng.getrandbits(64) for _ in range(30)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for bucket in (4, 1000):
        assert {tuple(r) for r in simhash_dedup.links(df, 3, bucket).collect()} == want


def test_simhash_edges(docs, no_docs):
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in simhash_dedup.near_duplicates(docs).collect())
    assert got == [(0, 1), (1, 1), (1, 1), (2, 2), (3, 2), (4, 4), (5, 2), (6, 2)]
    kept = simhash_dedup.deduplicate(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4] and kept.columns == docs.columns
    assert simhash_dedup.deduplicate(no_docs).count() == 0


# 4, 5 ------------------------------------------------------------------------

@pytest.mark.parametrize(("key", "label", "least"), [("op4_toxicity", "toxic", 0.85), ("op5_pu_quality", "quality", 0.9)])
def test_held_out_accuracy(spark, key, label, least):
    sf = SF_SMALL.replace("0.001", "0.01")
    got = registry.QUERIES[key](spark, sf).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    y = got[got.held_out].merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    assert (y.predicted == y[label]).mean() >= least


def test_scores_edges(docs, no_docs, labels):
    assert pu_quality.classify(docs, labels).where("score between 0 and 1").count() == 8
    assert pu_quality.classify(docs, labels.limit(0)).count() == 8
    assert pu_quality.classify(no_docs, labels).count() == 0
    for known in (labels, labels.limit(0)):
        kept = toxicity.keep_clean(docs, toxicity.train(docs, known))
        assert kept.columns == docs.columns and kept.where("text IS NULL").count() == 2
    assert toxicity.keep_clean(no_docs, toxicity.train(no_docs, labels)).count() == 0


def test_grammar_prefers_aimed_over_denied():
    g = toxicity.Grammar(toxicity.Lexicon())
    aimed, denied, quoted = (g.clause(t.split())[0] for t in ("you are an idiot", "you are not an idiot", "she said idiot"))
    assert aimed > denied > 0 and aimed > quoted > 0


def test_lexicon_weight_of_a_frequent_toxic_word():
    word = "idiotically"
    lexicon = toxicity.Lexicon({n: (4000, 0) for n in toxicity.nodes_of(word)}, frozenset({word}), 4000, 4000)
    assert 20 < lexicon.weight(word) < 100 and 20 < lexicon.weight(word, 1) < 100
    clean = toxicity.Lexicon({n: (0, 4000) for n in toxicity.nodes_of(word)}, frozenset({word}), 4000, 4000)
    assert clean.weight(word) == 0


def test_lexicon_takes_all_nodes(spark):
    import itertools
    words = ["tox" + "".join(x) for x in itertools.product("abcdefghijklm", repeat=4)]
    bad, seen = words[:3500], words[3500:26000]
    rows = [(" ".join(bad), 1)] * 20 + [(" ".join(seen), 0)] * 2 + [("fine", 0)] * 398
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, y int"))
    assert set(bad) <= lexicon.accepted and all(lexicon.counts[w] == (20, 0) for w in bad)
    assert all(lexicon.counts[w] == (0, 2) for w in seen)
    assert lexicon.counts["tox*"] == (20, 2) and 0 < lexicon.weight(seen[-1]) < lexicon.weight("toxzzzz") < lexicon.weight(bad[0])


def test_sums_of_the_risk():
    import numpy as np
    rng = np.random.default_rng(1)
    x, p = np.column_stack([np.ones(50), rng.normal(size=(50, 2))]), rng.random(50) < 0.4
    w = rng.normal(size=3)
    s = pu_quality.Sums.of(x, p, w)
    eps = 1e-6
    moved = [pu_quality.Sums.of(x, p, w + eps * e) for e in np.eye(3)]
    assert np.allclose([(m.bad_all - s.bad_all) / eps for m in moved], s.grad_all, atol=1e-3)
    assert np.allclose([(m.bad_pos - s.bad_pos) / eps for m in moved], s.grad_pos, atol=1e-3)
    back = pu_quality.Sums.of_flat(s.flat(), 3)
    assert np.array_equal(back.hess_all, s.hess_all) and np.array_equal(back.x_pos, s.x_pos)
    z = x @ w
    plain = 0.3 * np.logaddexp(0, -z[p]).mean() + max(0, np.logaddexp(0, z).mean() - 0.3 * np.logaddexp(0, z[p]).mean())
    assert np.isclose(s.risk(w, 50, p.sum(), 0.3), plain + pu_quality.RIDGE / 2 * (w[1:] @ w[1:]))


@pytest.mark.parametrize(("apart", "prior"), [(0.5, 0.3), (3.0, 0.3), (3.0, 0.6), (3.0, 0.45), (8.0, 0.5)])
def test_least_risk_is_feasible_and_lower_than_its_neighbours(apart, prior):
    """Also where the prior is above the true share (0.4), so that the constraint binds."""
    import numpy as np
    rng = np.random.default_rng(7)
    good = rng.random(4000) < 0.4
    x = np.column_stack([np.ones(4000), rng.normal(size=(4000, 3)) + apart * good[:, None] * [1, 0.5, 0]])
    known = good & (rng.random(4000) < 0.5)
    at = lambda ws: [pu_quality.Sums.of(x, known, w) for w in ws]
    n, pos = 4000, known.sum()
    w = pu_quality.minimise(at, pu_quality.start(4, prior), n, pos, prior, 1e-7)
    (s,) = at([w])
    assert s.bad_part(n, pos, prior) >= 0
    here = s.risk(w, n, pos, prior)
    for _ in range(300):
        v = w + rng.normal(size=4) * 10 ** rng.uniform(-3, 0)
        (t,) = at([v])
        if t.bad_part(n, pos, prior) >= 0:
            assert t.risk(v, n, pos, prior) > here - 2e-3


def test_prior_from_positives_and_unlabelled():
    import numpy as np
    rng = np.random.default_rng(3)
    for share in (0.15, 0.5, 0.8):
        good = rng.random(20_000) < share
        score = np.clip(rng.normal(0.35, 0.1, 20_000) + 0.3 * good, 0, 0.999)
        known = good & (rng.random(20_000) < 0.3)
        every, of_good = (np.bincount((score[m] * 1000).astype(int), minlength=1000) for m in (np.full(20_000, True), known))
        assert abs(pu_quality.estimate_prior(every, of_good) - share) < 0.06


def test_quality_model_of_the_tables_keeps_the_constraint(spark):
    import numpy as np
    sf = SF_SMALL.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = pu_quality.with_features(docs, labels, "quality", "doc_id", "text")
    model = pu_quality.train(rows)
    got = rows.toPandas()
    x = np.column_stack([np.ones(len(got)), (np.stack(got.x.to_numpy()) - np.array(model.mean)) / np.array(model.scale)])
    known, w = (got.y == 1).to_numpy(), np.array(model.weights)
    s = pu_quality.Sums.of(x, known, w)
    assert s.bad_part(len(got), known.sum(), model.prior) >= 0
    labelled = pd.read_parquet(f"{sf}/labels.parquet")
    assert abs(model.prior - labelled.quality.mean()) < 0.1
    y = got.merge(labelled, left_on="id", right_on="doc_id")
    y = y[(y.id.map(lambda i: __import__("zlib").crc32(str(i).encode())) % 3 == 1)]
    alone = model.logits(np.stack(y.x.to_numpy())) >= 0            # without the link
    linked = model.score(np.stack(y.x.to_numpy())) >= 0.5
    print("held out: alone", (alone == (y.quality == 1)).mean(), "with link", (linked == (y.quality == 1)).mean(), "prior", model.prior, "bad part", s.bad_part(len(got), known.sum(), model.prior))
    assert (alone == (y.quality == 1)).mean() >= 0.9 and (linked == (y.quality == 1)).mean() >= 0.95


# 6 ---------------------------------------------------------------------------

def test_license_base_against_brute_force(spark):
    d = table("documents")
    got = {r["doc_id"]: r for r in registry.op6_license_scan(spark, SF_SMALL).collect()}
    for i, text in zip(d.doc_id, d.text, strict=True):
        words = license_scan.WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places = [(k, label) for p, label in license_scan.BASE.items() for k in range(len(words)) if words[k:k + len(p.split())] == p.split()]
        starts = [k for k, _ in places]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places})) and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}


def test_license_fuzzy_against_brute_force():
    rng, scanner = random.Random(2), license_scan.Scanner()
    for n in scanner.notices:
        for _ in range(6):
            text = list(n.text.strip())
            for _ in range(rng.randint(0, n.edits)):
                text[rng.randrange(1, len(text) - 1)] = rng.choice("xyz")
            line = " ".join([*rng.choices("foo bar baz license the".split(), k=20), "".join(text), *rng.choices("foo bar baz".split(), k=20)])
            whole = {m.label for m in scanner.notices if regex.search(f"(?:{regex.escape(m.text)}){{e<={m.edits}}}", f" {line} ")}
            found = {m[0] for m in scanner.scan(line)["matches"]}
            assert found <= whole and (not whole or found)
            if "".join(text) == n.text.strip():
                assert n.label in found


def test_license_neighbouring_notices():
    scanner = license_scan.Scanner()

    def found(text, label):
        return [m[1:4] for m in scanner.scan(text)["matches"] if m[0] == label]
    assert found("mozila public license or mozilla public license", "mpl") == [(0, 2, 1), (4, 6, 0)]
    bad, good = "all rights reservd c ", "all rights reserved "
    for text, edits in ((bad * 10 + good, [1] * 10 + [0]), (good + "c " + bad * 10, [0] + [1] * 10), (good * 50, [0] * 50), ((good + bad) * 9, [0, 1] * 9)):
        got = found(text, "all-rights-reserved")
        assert [m[2] for m in got] == edits and all(b - a == 2 for a, b, _ in got) and len(set(got)) == len(edits)
    rng = random.Random(6)
    for _ in range(30):
        picked = rng.choices(scanner.notices, k=30)
        got = scanner.scan("".join(n.text for n in picked))["matches"]
        ends, at = set(), 0
        for n in picked:
            size = len(n.text.split())
            ends.add((n.label, at, at + size - 1, 0))
            at += size
        assert ends <= {m[:4] for m in got}


def test_license_spans_and_edges(docs, no_docs):
    r = license_scan.Scanner().scan("The MIT License. mit license mit license; Mozila Public License")
    assert r["places"] == [(1, "mit"), (3, "mit"), (5, "mit")] and [m[:4] for m in r["matches"] if m[0] == "mpl"] == [("mpl", 7, 9, 1)]
    got = license_scan.scan(docs)
    assert got.count() == 8 and got.where("n_words = 0 AND n_base = 0 AND first_word IS NULL AND labels = '' AND score = 0").count() == 4
    assert license_scan.scan(no_docs).count() == 0


# 7 ---------------------------------------------------------------------------

def test_mix(spark):
    got = registry.op7_mixing(spark, SF_SMALL).toPandas()
    d = table("documents")
    assert len(got) == len(d) and (got.taken <= 3 * got["size"]).all()
    by = got.groupby("source").agg(size=("size", "sum"), taken=("taken", "sum"), target=("target", "first"), top=("size", "max"), known=("source_size", "first"))
    assert (by["size"] == by.known).all() and abs(by.target.sum() - got["size"].sum()) < 1
    assert (by.target <= 3 * by["size"] + 1e-6).all() and ((by.taken - by.target).abs() <= 2 * by.top).all()
    again = registry.op7_mixing(spark, SF_SMALL).toPandas()
    assert got.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()


def test_mix_small_source_beside_a_hot_one(spark):
    rng = random.Random(12)

    def units(src, n):
        return [(src, max(1, int(rng.lognormvariate(4, 1))), rng.getrandbits(40), src * 10_000 + k, False, rng.getrandbits(40), 1, rng.uniform(0.05, 0.95)) for k in range(n)]
    schema = "src long, size long, mark long, id0 long, no_id boolean, th long, occ int, p double"
    hot, small = units(0, 400), [units(s, 40) for s in range(1, 5)]

    def drawn(rows):
        return {r["id0"]: r["drawn"] for r in mixing._balanced(spark.createDataFrame(rows, schema), 64).collect()}
    both = drawn(hot + [u for s in small for u in s])
    assert len(both) == 560
    for rows in small:
        alone = drawn(rows)
        assert alone == {u[3]: both[u[3]] for u in rows}        # a hot source elsewhere changes nothing
        sizes = [u[1] for u in rows]
        miss = abs(sum(both[u[3]] * u[1] for u in rows) - sum(u[7] * u[1] for u in rows))
        assert miss <= 0.2 * sum(sizes) / len(sizes)


def test_mix_edges(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (None, "x y z", None), (2, None, "s"), (3, "", "t")]
    df = spark.createDataFrame([(i, t, s, 7) for i, t, s in rows], "doc_id long, text string, source string, size int")
    assert mixing.mix(df).count() == 5
    assert mixing.apply_mix(df).columns == df.columns
    assert mixing.mix(df.limit(0)).count() == 0


# 8, 10 -----------------------------------------------------------------------

@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_sql(spark, duck, key):
    from check_oracle import compare
    assert compare(spark, duck, SF_SMALL, key, registry.QUERIES[key], registry.oracle_sql()[key], check_types=True)["status"] == "ok"


def test_native_edges(docs, no_docs):
    assert quality_rules.judge(docs).count() == sharding.place(docs).count() == 8
    assert quality_rules.judge(no_docs).count() == sharding.place(no_docs).count() == 0
    assert {"doc_id", "text"} <= set(sharding.place(docs).columns)


@pytest.mark.parametrize("key", ["op8_quality_rules", "op10_sharding"])
def test_native_plans_have_no_python(spark, key):
    plan = registry.QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow", plan)


# 9 ---------------------------------------------------------------------------

def test_leaks(spark):
    items = table("benchmark")
    rng = random.Random(4)
    passage = max(items.text, key=len)
    edited = list(decontamination.normal(passage)[:250])
    edited[60] = "#"
    texts = {1: "filler words here " * 40 + passage + " more", 2: "clean text of other words " * 30, 3: None, 4: "", 5: "lead in " * 9 + "".join(edited) + " tail", 6: " ".join(rng.choices("alpha beta gamma delta".split(), k=400))}
    df = spark.createDataFrame([(k, t, "x", None, "y") for k, t in texts.items()], DOCS)
    kept = decontamination.decontaminate(df, spark.createDataFrame(items))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 6] and kept.columns == df.columns
    assert decontamination.decontaminate(df.limit(0), spark.createDataFrame(items)).count() == 0
    assert decontamination.decontaminate(df, spark.createDataFrame(items).limit(0)).count() == 6


def test_leaks_of_parts_and_short_items():
    rng = random.Random(8)

    def say(n):
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz    ", k=n))
    least = decontamination.SHORT + decontamination.STEP - 1
    item = decontamination.normal(say(900))
    index = decontamination.Index([(1, item), (2, "What is 6 times 7?"), (3, "  "), (4, item[:233])])
    for _ in range(60):
        n = rng.choice([least, 64, 150, 240, 350])
        at = rng.randrange(1, len(item) - n)
        part = item[at:at + n]
        if part != part.strip():
            continue
        assert 1 in {x[0] for x in index.search(f"{say(300)} #{part}# {say(300)}")}
    edited = item[100:200]
    edited = edited[:20] + "#" + edited[21:70] + edited[72:]
    assert 1 in {x[0] for x in index.search(say(200) + edited + say(200))}
    assert {1, 4} == {x[0] for x in index.search(say(200) + item[:210] + say(200))}  # nine tenths of an item
    assert [x[0] for x in index.search("so: what  is 6 TIMES 7? Yes")] == [2]
    assert index.search("somewhat is 6 times 7?") == index.search("") == index.search(say(3000)) == []
    whole, = decontamination.Index([(1, item[:200])]).search("lead in " + item[:200])
    assert whole[:4] == (1, 8, 208, 0)


# pipeline


def test_leaks_do_not_depend_on_the_slices(monkeypatch):
    """Items with a common stem: few hits at once find what many at once find, and every item that a plain search finds."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(200)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    stem = say(14)
    items = tuple((f"i{k}", f"{stem} {say(12)}") for k in range(40))
    index = decontamination.Index(items)
    texts = [f"{say(30)} {items[k][1]} {say(20)}" for k in range(4)] + [f"{stem} " * 8, say(200), items[5][1][60:]]
    want = [index.search(t) for t in texts]
    for few in (1, 50, 1000):
        monkeypatch.setattr(decontamination, "SLICE", few)
        assert [index.search(t) for t in texts] == want
    for t, found in zip(texts, want, strict=True):
        assert {i for i, text in items if text in t} <= {x[0] for x in found if x[3] == 0}
    assert len(want[4]) == 40 and want[5] == []          # the stem holds whole short pieces of all items
    assert len({i for i, *_ in want[6]}) >= 1


def test_leaks_held_against_plain_edit_distance():
    """Whole items with edits up to the budget are found, those far beyond it aren't."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))

    def distance(piece, text):  # edits that turn the piece into some part of the text
        row = [0] * (len(text) + 1)
        for i, c in enumerate(piece, 1):
            last, row = row, [i]
            for j, d in enumerate(text, 1):
                row.append(min(last[j - 1] + (c != d), last[j] + 1, row[-1] + 1))
        return min(row)

    items = tuple((k, say(rng.choice((5, 6, 7)))[:48].strip()) for k in range(12))    # one piece each
    items = tuple(x for x in items if len(x[1]) >= decontamination.MIN_CHARS)
    index = decontamination.Index(items)
    for _ in range(60):
        item = rng.choice(items)
        x = list(item[1])
        for _ in range(rng.randint(0, 8)):
            at = rng.randrange(len(x))
            x[at:at + 1] = rng.choice(([], ["z"], [x[at], "z"]))
        text = decontamination.normal(f"{say(6)} {''.join(x)} {say(6)}")
        want = set()
        for p, (piece, _) in enumerate((i[1], 0) for i in items):
            if distance(piece, text) <= int(index.edits[p]):
                want.add(items[p][0])
        got = index.search(text)
        assert {g[0] for g in got} == want
        assert all(g[3] == distance(dict(items)[g[0]], text) for g in got)


def test_string_ids_in_the_stages(spark):
    rows = [("b", "the same words stand here twice over and over again", "s"), ("a", "the same words stand here twice over and over again", "s"), (None, "quite another text about other things", "t"), ("c", None, None)]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string")
    assert {r["doc_id"] for r in simhash_dedup.deduplicate(df).collect()} == {"a", "c", None}
    taken = mixing.apply_mix(df)
    assert taken.columns == df.columns and sorted(map(str, taken.collect())) == sorted(map(str, mixing.apply_mix(df).collect()))
    item = spark.createDataFrame([("q1", rows[0][1])], "item_id string, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(df, item).collect()) == [("a", "q1"), ("b", "q1")]
    assert decontamination.decontaminate(df, item).count() == 2


def test_pipeline_and_registry(spark):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "mixing", "sharding"]
    got = entry.queries()["pipeline"](spark, SF_SMALL)
    source = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert set(source.columns) < set(got.columns) and got.count() > 0
    assert got.select("doc_id").distinct().join(source, "doc_id").count() == got.select("doc_id").distinct().count()
    assert got.where(F.col("shard").isNull()).count() == 0
    assert {k.split("_")[0] for k in registry.QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_license_windows_are_verified_once_and_none_is_lost():
    import random
    import time
    from diamondlake.llm import license_scan as LS
    scanner = LS.Scanner()
    for text in ("permission to use " * 20000, " ".join(f"permission to use w{i}" for i in range(20000))):
        start = time.perf_counter()
        assert scanner.scan(text)["matches"] == []
        assert time.perf_counter() - start < 8      # minutes when each seed hit was verified; slow machines included
    # Damaged notices: what the grams let pass is what the pattern finds.
    rnd = random.Random(5)
    for n in scanner.notices:
        for _ in range(60):
            chars = list(n.text)
            for _ in range(rnd.randint(0, n.edits + 2)):
                at = rnd.randrange(len(chars))
                chars[at:at + rnd.randint(0, 1)] = rnd.choice(["", "x", " ", "qz"[rnd.randint(0, 1)]])
            window = "some" + "".join(chars) + "words"
            assert n.possible(window) or not n.pattern.search(window)


def test_html_long_lists_are_aligned_exactly(monkeypatch):
    rng = random.Random(5)

    def page(n):
        kinds = ["<p>{0}</p>", "<ul><li>{0}</li><li>z</li></ul>", "<div><p>{0}</p><p>{1}</p></div>", "<div><p>{0}</p></div>", "<ul><li>{0}</li></ul>"]
        return html_extraction.parse("<body>" + "".join(rng.choice(kinds).format(rng.choice("abcdefgh"), rng.choice("abc")) for _ in range(n)) + "</body>")

    def score(a, b, pairs):
        return len(pairs) + 0.5 * sum(a.digest[i] == b.digest[j] != 0 for i, j in pairs)
    for _ in range(150):
        a, b = page(rng.randrange(14)), page(rng.randrange(14))
        whole = html_extraction.match(a, b)
        with monkeypatch.context() as m:
            m.setattr(html_extraction, "CELLS", 0)
            rows = html_extraction.match(a, b)
        assert score(a, b, rows) == score(a, b, whole) and all(a.label[i] == b.label[j] for i, j in rows)
        partners = [j for _, j in sorted(rows)]
        assert partners == sorted(set(partners))
