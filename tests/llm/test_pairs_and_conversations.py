"""Hard negatives, conversation repair and the n-gram join against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from diamondlake.llm import conversation_repair as C
from diamondlake.llm import hard_negatives as H
from diamondlake.llm import ngram_join as J
from tests.conftest import SF_CHECK, SF_SMALL

# 11 --------------------------------------------------------------------------


def plain_negatives(rows, every, positives=5, negatives=10, low=30, high=90):
    fine = [(i, m, [H._exact(x, 256) for x in v]) for i, m, v in rows if i is not None and m is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, m, v in {(i, m, tuple(v)) for i, m, v in fine if i % every == 0}:
        scored = sorted((-max(min(sum(a * b for a, b in zip(v, w, strict=True)), H.LONG_MAX), -H.LONG_MAX), j, k) for j, k, w in fine if len(w) == len(v))
        for p in [x for x in scored if x[2] == m and x[1] != i][:positives]:
            hits = [x for x in scored if x[2] != m and low * -p[0] <= 100 * -x[0] <= high * -p[0]][:negatives]
            out += [(i, p[1], k + 1, x[1], -p[0], -x[0]) for k, x in enumerate(hits)]
    return sorted(out)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_CHECK])
def test_hard_negatives_query(spark, sf):
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = entry.queries()["op11_hard_negatives"](spark, sf)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, 100) != []


def test_hard_negatives_odd_rows(spark):
    rng = random.Random(3)
    vectors = [None, [], [float("nan"), 1.0], [1e200, 2.0], [None, 1.0]]
    rows = [(rng.choice([None, *range(40)]), rng.choice([0, 1, None]), rng.choice([*vectors, [rng.choice([0.0, .25, -.5, 1.0]) for _ in range(rng.choice([2, 3]))]])) for _ in range(300)]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "vec_id long, label int, embedding array<double>, id string, vec string, __anchor int")
    want = plain_negatives(rows, 5)
    for size in (H.BLOCK_BYTES, 3000):                  # one block of anchors, and many
        assert sorted(map(tuple, H.mine(df, F.col("vec_id") % 5 == 0, block_bytes=size).collect())) == want != []
    assert H.mine(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert H.mine(df, F.lit(False)).count() == 0


def test_hard_negatives_of_text_ids_keep_few_pairs_per_task(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(k, rng.randrange(3), [rng.random() for _ in range(4)]) for k in range(400)]
    monkeypatch.setattr(H, "GATHER", 50)
    want = plain_negatives(rows, 20)
    named = spark.createDataFrame([(f"{i:04}", m, v) for i, m, v in rows], "vec_id string, label int, embedding array<double>")
    got = H.mine(named, F.col("vec_id").cast("int") % 20 == 0).collect()
    assert sorted((int(a), int(p), r, int(n), x, y) for a, p, r, n, x, y in got) == want


def test_stream_opens_windows_in_score_order():
    keys = [((1, "a"), -100, 0, "p"), ((1, "a"), -95, 1, "high"), ((1, "a"), -90, 1, "n1"), ((1, "a"), -50, 0, "q"), ((1, "a"), -45, 1, "n2"), ((1, "a"), -29, 1, "n3"), ((2, "b"), 0, 0, "z"), ((2, "b"), 0, 1, "n4")]
    got = list(H.stream(iter((k, None) for k in keys), 2, 30, 90))
    assert got == [("a", "p", 1, "n1", 100, 90), ("a", "p", 2, "n2", 100, 45), ("a", "q", 1, "n2", 50, 45), ("a", "q", 2, "n3", 50, 29), ("b", "z", 1, "n4", 0, 0)]


# 12 --------------------------------------------------------------------------


def plain_repair(codes):
    """Cheapest (cost, audit) by dynamic programming over whole strings."""
    best = [(0, ""), (6, "II"), (3, "I"), (0, "")]
    for code in reversed(codes):
        read = []
        for q in range(4):
            options = [(4 + best[q][0], "D" + best[q][1])]
            if code != C.MUST_GO:
                late, role, to = 3 if code & 4 else 0, code & 3, 3 if q == 2 else 2
                if role and (role == to or role == 1 and q == 0):
                    options.append((late + best[role][0], "K" + best[role][1]))
                options.append((3 + late + best[to][0], "R" + best[to][1]))
            read.append(min(options))
        best = []
        for q in range(4):
            options, state = [read[q]], q
            for n in range(1, 5):
                state = 3 if state == 2 else 2
                options.append((3 * n + read[state][0], "I" * n + read[state][1]))
            best.append(min(options))
    return best[0]


def test_auction_finds_the_cheapest_least_repair():
    rng = random.Random(1)
    for _ in range(1500):
        codes = bytes(rng.choice([0, 1, 2, 3, 2, 3, 4, 5, 6, 7, 8]) for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 17, 40])))
        assert C.repair(codes) == plain_repair(codes)
    for codes in itertools.product(range(9), repeat=3):
        assert C.repair(bytes(codes)) == plain_repair(bytes(codes))


def test_converged_prices_are_distances():
    rng = random.Random(2)
    for _ in range(50):
        codes = bytes(rng.randrange(9) for _ in range(12))
        net = C.Lattice(codes, C.FINAL)
        for i, q in itertools.product(range(13), range(4)):
            far = net.auction((i, q))
            steps = [cost + net.auction(to) for _, cost, to in net.out.get((i, q), [])]
            assert far == (min(steps) if steps else C.FINAL[q])


def plain_conversations(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        convs[c] += []
        if kind:
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            convs[c] += [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    out = []
    for c, turns in convs.items():
        turns.sort(key=lambda y: (y[0] is not None, y[0] or 0, y[1], hashlib.md5(y[2].encode()).hexdigest()))
        at = [t for t, _, _ in turns if t is not None]
        seen, faults, codes = set(), [0, 0, 0], []
        for _, r, x in turns:
            said, role = x.strip(" \t\n\x0b\x0c\r"), " sua".find(r[:1]) if r[:1] else 0
            fault = 1 if not said else 2 if (r, x) in seen else 3 if said[-1] not in ".!?" else 0
            if fault:
                faults[fault - 1] += 1
            codes.append(8 if fault in (1, 2) else max(role, 0) + (4 if fault == 3 else 0))
            seen.add((r, x))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit = plain_repair(codes)
        lines, rest, state = [], iter(turns), 0
        for edit in audit:
            _, r, x = next(rest) if edit != "I" else (None, "", "")
            if edit == "D":
                continue
            state = " sua".find(r[:1]) if edit == "K" else 3 if state == 2 else 2
            lines.append(f"{r if edit == 'K' else ['', '', 'user', 'assistant'][state]}:{x}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out.append((c, max(at) - min(at) + 1 - len(set(at)) if at else 0, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def test_conversation_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = entry.queries()["op12_conversation_repair"](spark, SF_CHECK)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_conversations(rows)


def test_conversations_with_odd_rows(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, 0, 1, 2, 3, 4, 9]), rng.choice([None, "", "user", "assistant", "system", "tool", "u"]), rng.choice([None, "", " \n", "Hi.", "Hi", "What? ", "né "])) for _ in range(600)]
    rows += [(100, t, "user" if t % 2 == 0 else "assistant", "word " * 20_000 + ".") for t in range(40)]        # long texts, more rows than a block
    rows += [(200, 0, "user", "Dropped?")] * 3
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, copy int, said string")
    got = C.repair_all(C.damage(df))
    assert sorted(map(tuple, got.collect()), key=str) == plain_conversations(rows)
    assert C.repair_all(C.damage(df.limit(0))).count() == 0
    named = df.withColumn("conv_id", F.concat(F.lit("c"), F.col("conv_id")))
    assert C.repair_all(C.damage(named)).count() == got.count()


def test_conversation_without_rows_after_damage(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    row, = C.repair_all(C.damage(spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string"))).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# 13 --------------------------------------------------------------------------


def plain_join(rows, num=90, den=100):
    """(id, size of the set, least id reachable) per row, by counting all common grams of all pairs."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(zip(w, w[1:], w[2:], strict=False)) if len(w) >= 3 else frozenset([tuple(w)] if w else []))
    classes = defaultdict(list)
    for k, s in enumerate(sets):
        classes[s].append(k)
    keys = [s for s in classes if s]
    parent = list(range(len(keys)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    holders, links = defaultdict(list), set()
    for k, s in enumerate(keys):
        for m, common in Counter(m for g in s for m in holders[g]).items():
            if den * common >= num * (len(s) + len(keys[m]) - common):
                links.add((m, k))
                parent[root(k)] = root(m)
        for g in s:
            holders[g].append(k)
    least = {}
    for k, s in enumerate(keys):
        least.setdefault(root(k), []).extend(rows[x][0] for x in classes[s] if rows[x][0] is not None)
    number = {s: k for k, s in enumerate(keys)}
    return sorted(((rows[k][0], len(s), rows[k][0] if not s else min(least[root(number[s])], default=None)) for k, s in enumerate(sets)), key=str), len(links)


def test_ngram_join_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op13_ngram_join"](spark, SF_CHECK)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    want, links = plain_join(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want and links > 0


def family(rng, size, n, edits):
    base = [f"w{rng.randrange(10_000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.choice(edits)):
            words[rng.randrange(size)] = f"x{rng.randrange(50)}"
        out.append(" ".join(words[:len(words) - rng.choice([0, 0, 0, 1, 2])]))
    return out


@pytest.mark.parametrize("num", [90, 75])
def test_ngram_join_of_families_and_odd_rows(spark, num):
    rng = random.Random(6)
    texts = [t for size in (9, 10, 12, 30, 60, 100) for t in family(rng, size, 60, (0, 0, 1, 1, 2, 3))]
    rows = [(rng.choice([k, k, None, 5]), rng.choice([t, t.upper()])) for k, t in enumerate(texts)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "One"), (905, "one two"), (None, "one two"), (906, "long text " * 30_000)]
    df = spark.createDataFrame([(*r, "a", "b", 0) for r in rows], "doc_id long, text string, id string, set_id string, n int")
    want, _ = plain_join(rows, num)
    assert sorted(map(tuple, J.join_documents(df, num=num).collect()), key=str) == want
    assert J.join_documents(df.limit(0)).count() == 0


def test_ngram_join_of_a_dense_family_verifies_few_pairs(spark):
    rng = random.Random(7)
    rows = list(enumerate(family(rng, 300, 300, (0, 1, 2, 9))))
    want, links = plain_join(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, J.join_documents(df).collect()), key=str) == want
    _, classes, found = J.near_sets(df, "doc_id", "text", 3, 90, 100)
    assert found.count() < 3 * len(rows) < links / 10 and classes.where("component IS NOT NULL").count() > 0
    checked = found.select("a", "b", (100 * F.col("overlap") >= 90 * F.col("union")).alias("ok"), (F.col("a") < F.col("b")).alias("once"))
    assert checked.where("NOT ok OR NOT once").count() == 0
