"""Embedding near-duplicates, spelling variants and ranked search against plain definitions on small tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrain.llm import op11_embedding_dedup as op11
from vitalgrain.llm import op12_spelling as op12
from vitalgrain.llm import op13_lexical_search as op13

# ---- embeddings


def brute_links(rows, least=0.98):
    """By place: links and the smallest id that is reachable."""
    good = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, near = [0] * len(rows), {i: [] for i in good}
    for i in good:
        for j in good:
            if i != j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and op11.exact_cosine(np.array(rows[i][1], float), np.array(rows[j][1], float)) >= least:
                links[i] += 1
                near[i].append(j)
    comp = [r[0] for r in rows]
    for i in good:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        comp[i] = min(ids) if ids else None
    return sorted(map(repr, zip((r[0] for r in rows), links, comp)))


def near_rows(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1)).withColumn("twin", F.lit("x"))
    got = op11.near_vectors(df, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return sorted(repr((r.vec_id, r.n_links, r.component_id)) for r in got)


def vectors(seed, n, dim=8, labels=2):
    """Chains of near vectors around a few centres, copies, and odd rows."""
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for _ in range(n):
        v = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 6))):
            v = v + rng.normal(size=dim) * 0.08
            rows.append((at, (v * rng.choice([1.0, 3.0, 1e-9, 1e12])).tolist(), int(rng.integers(labels))))
            at += 1
            if rng.random() < 0.2:
                rows.append((at, rows[-1][1], rows[-1][2]))
                at += 1
    return rows


@pytest.mark.parametrize("block_rows", [3, 1000])
def test_links_by_definition(spark, block_rows):
    rows = vectors(1, 40)
    assert near_rows(spark, rows, block_rows=block_rows, fanout=2) == brute_links(rows)


def test_odd_vectors(spark):
    one = [1.0, 0.0, 0.0]
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0] * 3, 0), (4, [1.0, None, 0.0], 0), (5, [1.0, float("nan"), 0.0], 0), (6, [float("inf"), 0.0, 0.0], 0), (7, one, None),
        (9, one, 0), (8, [2.0, 0.0, 0.0], 0), (9, one, 0), (None, one, 0), (None, [0.0, 1.0, 0.0], 0), (10, one, 1), (11, [1.0, 0.0], 0), (12, [-1.0, 0.0, 0.0], 0), (13, [5e-324, 0.0, 0.0], 0), (14, [1e308, 1e307, 0.0], 0),
        (15, [-0.0, 1.0, -0.0], 2), (16, [0.0, 1.0, 0.0], 2),
    ]
    assert near_rows(spark, rows) == brute_links(rows)
    assert near_rows(spark, []) == []


def test_the_bound_itself_links(spark):
    """0.6 * 0.8 + 0.8 * 0.6 is 0.96 in exact numbers, and the rounded one is decided by the components."""
    rows = [(1, [3.0, 4.0], 0), (2, [4.0, 3.0], 0), (3, [3.0, 3.9999], 0)]
    assert near_rows(spark, rows, least=0.96) == brute_links(rows, 0.96)


def test_distant_blocks_are_skipped(spark):
    """Intervals of far clusters never meet, and those of one tight cluster need no product."""
    centres = np.eye(4)
    rows = [(i, (centres[i % 4] + 1e-4 * np.random.default_rng(i).normal(size=4)).tolist(), 0) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = op11.near_vectors(df, block_rows=20, fanout=2).collect()
    assert {r.n_links for r in got} == {99} and {r.component_id for r in got} == {0, 1, 2, 3}
    boxes = spark.createDataFrame([("a", 4, i, [float(c) - 0.01 for c in centres[i % 4]], [float(c) + 0.01 for c in centres[i % 4]]) for i in range(8)], "label string, dim int, at long, low array<double>, high array<double>")
    pairs = {(r.a, r.b) for r in op11._pairs(boxes, 0.2, 2).collect()}
    assert pairs == {(i, j) for i in range(8) for j in range(i, 8) if i % 4 == j % 4}


# ---- spelling


def spelled(texts, shortest=7, least=2, typos=31, times=10):
    counts = Counter()
    for doc, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if typos and h % typos == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}

    def edit(s, t):
        return s != t and (len(s) == len(t) and sum(a != b for a, b in zip(s, t)) == 1 or len(t) == len(s) + 1 and any(t[:i] + t[i + 1 :] == s for i in range(len(t))))

    near = {w: [x for x in counts if edit(w, x) or edit(x, w)] for w in counts}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, n, len(near[w]), forms[w], counts[forms[w]] if forms[w] else None, root))
    return sorted(out)


def variant_rows(spark, texts, **options):
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("key", F.lit(2))
    return sorted(tuple(r) for r in op12.variants(op12.words(df), **options).select("word", "n", "n_near", "form", "form_n", "root").collect())


def typed(seed, n):
    """Words with shared beginnings and ends, in all counts, and words one edit away."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randint(7, 10))) for _ in range(12)]
    said = []
    for _ in range(n):
        w = list(rng.choice(stems))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(w))
            w[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "é", "B"])
        said += ["".join(w)] * rng.choice([1, 2, 2, 3, 40, 500])
    said += ["wanderer"] * 600 + ["wandererx"] * 40 + ["wandererxy"] * 3
    rng.shuffle(said)
    return [(i, " ".join(said[i::20])) for i in range(20)]


@pytest.mark.parametrize("group_chars", [40, 1 << 15])
def test_variants_by_definition(spark, group_chars):
    texts = typed(5, 150)
    got = variant_rows(spark, texts, group_chars=group_chars)
    assert got == spelled(texts) and any(r[3] for r in got) and any(r[3] != r[5] for r in got if r[3])


def test_odd_texts_of_words(spark):
    long = "ab" * 4000
    texts = [(1, None), (2, ""), (3, "123 ..."), (None, "Straßenbahn straßenbahn STRASSENBAHN ÀÉÎõüÿ7ÀÉÎõüÿa ÀÉÎõüÿa"), (None, "Straßenbahn"), (4, f"{long} {long} {long}c {long}c x{long} x{long}"), (4, f"{long}"), (5, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa aaaaaab aaaaaab")]
    assert variant_rows(spark, texts) == spelled(texts)
    assert variant_rows(spark, texts, group_chars=10) == spelled(texts)
    assert variant_rows(spark, []) == []


def test_every_near_word_reaches_the_bound():
    """The lists that are merged and the bound lose no pair, whatever the edit."""
    rng = random.Random(2)
    for _ in range(400):
        s = "".join(rng.choice("ab") for _ in range(rng.randint(1, 7)))
        t = list(s)
        at = rng.randrange(len(s) + 1)
        t[at : at + rng.randint(0, 1)] = rng.choice("abc")
        t = "".join(t)
        if len(t) in (len(s), len(s) + 1) and t != s:
            rests = sorted([s, t], key=lambda r: (len(r), r))
            index = op12.GramIndex(rests, len(s))
            found = [rests[j] for i in range(index.count_short()) for j in index.near(i)]
            assert found == [rests[1]], (s, t)


# ---- search


def ranked(docs, items, top_k=10):
    def terms(text):
        return re.findall("[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    held = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in held]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for (doc, c), size in zip(held, lengths):
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (25 + (75 * size * n) // total)))
            if score > 0:
                found.append((-score, doc is None, doc))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, rank, doc, -s) for rank, (s, _, doc) in enumerate(found[:top_k], 1)]
    return sorted(map(repr, out))


def found_rows(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("rank", F.lit(1)).repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    return sorted(repr(tuple(r)) for r in op13.search(d, i).select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("slice_hits,block_terms", [(1 << 20, 500_000), (7, 10)])
def test_ranks_by_definition(spark, monkeypatch, slice_hits, block_terms):
    monkeypatch.setattr(op13, "SLICE_HITS", slice_hits)
    monkeypatch.setattr(op13, "BLOCK_TERMS", block_terms)
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice(["the", "of", "Über", "naïve", "x1", "zwölf", "B52", "rare" + str(rng.randrange(50))]) for _ in range(n))
    docs = [(i, say(rng.randint(1, 40))) for i in range(120)]
    docs += [(200 + i, docs[i][1]) for i in range(30)]  # ties
    items = [(i, say(rng.randint(1, 8))) for i in range(15)]
    assert found_rows(spark, docs, items) == ranked(docs, items)


def test_odd_texts_of_searches(spark, monkeypatch):
    monkeypatch.setattr(op13, "PIECE", 16)
    docs = [(1, None), (2, ""), (3, "... \x00 !"), (4, "word"), (4, "word word"), (None, "word"), (None, "word"), (5, "a" * 5000 + " word " + "İ" * 300), (6, "﻿word  word"), (7, "other,text;other")]
    items = [(1, "word WORD"), (1, "other"), (2, None), (3, "!"), (4, "absent"), (None, "a" * 5000), (5, " word")]
    assert found_rows(spark, docs, items) == ranked(docs, items)
    assert found_rows(spark, [], items) == [] and found_rows(spark, docs, []) == []


def test_radix_order():
    keys = np.random.default_rng(1).integers(0, 1 << 50, 5000).astype(np.uint64)
    assert (op13._radix_order(keys) == np.argsort(keys, kind="stable")).all()
