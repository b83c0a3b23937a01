"""Exact and near duplicates, sharding and fingerprints against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from vitalgrain.llm import op4_fingerprints as op4
from vitalgrain.llm import op6_exact_dedup as op6
from vitalgrain.llm import op7_sharding as op7
from vitalgrain.llm import op9_near_dedup as op9

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, pairs):
    return spark.createDataFrame([(d, t, "en", f"s{(d or 0) % 3}", 1) for d, t in pairs], SCHEMA)


EDGE = [(5, None), (3, ""), (9, " "), (2, "a  b"), (1, "a\tb"), (4, "a b "), (7, "a b"), (8, "a b"), (8, "a b"), (None, "a b"), (None, "zz"), (10, "x" * 100_000), (11, "x" * 100_000)]


# ---- exact --------------------------------------------------------------------------------------


def squeeze(t):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_edges(spark):
    got = op6.duplicate_groups(docs(spark, EDGE)).collect()
    assert len(got) == len(EDGE)
    by = {}
    for d, t in EDGE:
        by.setdefault(hashlib.sha256(squeeze(t).encode()).hexdigest(), []).append(d)
    for r in got:
        group = by[r.text_sha256]
        assert r.group_size == len(group)
        assert r.keep_id == min((d for d in group if d is not None), default=None)
    assert all(sum(r.kept for r in got if r.text_sha256 == h) == 1 for h in by)


def test_exact_deduplicate_keeps_columns(spark):
    df = docs(spark, EDGE).withColumns({"sha": F.lit(1), "size": F.lit(2), "__maybe": F.lit(3), "word": F.lit(4)})
    kept = op6.deduplicate(df)
    assert kept.columns == df.columns
    want = {hashlib.sha256(squeeze(t).encode()).hexdigest() for _, t in EDGE}
    rows = kept.collect()
    assert len(rows) == len(want) and {hashlib.sha256(squeeze(r.text).encode()).hexdigest() for r in rows} == want
    assert {r.doc_id for r in rows} == {3, 9, 1, 4, 7, 10, None}


def test_exact_empty_table(spark):
    assert op6.duplicate_groups(docs(spark, [])).count() == 0
    assert op6.deduplicate(docs(spark, [])).count() == 0


def test_a_full_filter_changes_nothing(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("sha"))
    repeated = {r.sha for r in df.groupBy("sha").count().where("count > 1").collect()}
    for bound in (1 << 10, 1 << 20):
        words, cells = op6.repeat_filter(df, "sha", df.count(), bound)
        maybe = {r.sha for r in op6.possibly_repeated(df, "sha", words, cells).where("__maybe").collect()}
        assert repeated <= maybe


def test_ranges_of_digests_change_nothing(spark, sf_dir):
    """Filters of 256 cells: many ranges, each with one of its own."""
    df = docs(spark, EDGE).unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select(*docs(spark, []).columns).limit(150))
    digests = df.select("doc_id", op6._sha("text").alias("sha"), F.lit(0).alias("row"))
    assert len(op6._ranges(digests, digests.count(), 256)) > 3
    assert Counter(op6.duplicate_groups(df, bound=256).drop("kept").collect()) == Counter(op6.duplicate_groups(df).drop("kept").collect())
    assert Counter(r.text_sha256 for r in op6.duplicate_groups(df, bound=256).where("kept").collect()).most_common(1)[0][1] == 1
    assert Counter(op6.deduplicate(df, bound=256).collect()) == Counter(op6.deduplicate(df).collect())


def test_exact_plan_is_native(spark, sf_dir):
    plan = op6.op6_exact_dedup(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- sharding -----------------------------------------------------------------------------------


def check_shards(rows, count, texts):
    n = len(rows)
    sizes = Counter(r.shard for r in rows)
    assert all(n // count <= sizes.get(s, 0) <= -(-n // count) for s in range(count))
    for s, k in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(k))
    assert sorted((r["size"], r.text_crc32) for r in rows) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts)


def test_sharding(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = op7.shards(df, 6).collect()
    check_shards(rows, 6, [r.text for r in df.collect()])
    sources = Counter(r.source for r in rows)
    for s in range(6):
        mine = Counter(r.source for r in rows if r.shard == s)
        assert all(abs(mine[k] - v / 6) <= 2 for k, v in sources.items())
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    again = op7.shards(df.repartition(9), 6).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_sharding_edges(spark):
    df = spark.createDataFrame([(d, t, None, None if i % 2 else f"only{i}", 1) for i, (d, t) in enumerate(EDGE)], SCHEMA).withColumns({"key": F.lit(1), "shard": F.lit(2)})
    check_shards(op7.shards(df, 4).collect(), 4, [t for _, t in EDGE])
    check_shards(op7.op7_sharding.__globals__["shards"](df, 24).collect(), 24, [t for _, t in EDGE])
    assert op7.shards(docs(spark, [])).count() == 0


def test_sharding_of_null_ids_spreads(spark):
    df = spark.createDataFrame([(None, f"text {i}", None, "s", 1) for i in range(400)], SCHEMA)
    rows = op7.shards(df, 4).collect()
    check_shards(rows, 4, [f"text {i}" for i in range(400)])
    plan = op7.shards(df, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sharding_equals_plain_windows(spark, sf_dir):
    """The two-level ranks are those of one sort a source and one over all."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source").collect()
    strata = {}
    for r in df:
        strata.setdefault(r.source, []).append(r.doc_id)
    order = []
    for source, ids in strata.items():
        phase = (int(hashlib.md5(f"{op7.SEED}s{source}".encode()).hexdigest()[:8], 16) + 0.5) / 2**32
        ids.sort(key=lambda d: hashlib.md5(f"{op7.SEED}:{d}".encode()).hexdigest())
        order += [((k + 1 - phase) / len(ids), f"s{source}", k, d) for k, d in enumerate(ids)]
    n = len(order)
    want = {d: i * op7.SHARDS // n for i, (*_, d) in enumerate(sorted(order))}
    got = {r.doc_id: r.shard for r in op7.shards(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    assert got == want


# ---- fingerprints -------------------------------------------------------------------------------


def test_edited_fingerprints(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r for r in op4.edited_fingerprints(df).collect()}
    texts = sorted(((r.doc_id, r.text) for r in df.collect()), reverse=True)
    simhash = op4.SimHash()
    assert len(rows) == len(texts)
    for i, (d, t) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = rows[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (simhash.of(t).hex(), simhash.of(edited).hex())
        assert (r.near_edited, r.near_next) == (op4.likeness(simhash.of(t), simhash.of(edited)), op4.likeness(simhash.of(t), simhash.of(after)))
    assert sum(r.near_edited for r in rows.values()) > sum(r.near_next for r in rows.values()) + 0.1 * len(rows)


def test_fingerprint_edges(spark):
    got = op4.edited_fingerprints(docs(spark, EDGE)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _ in EDGE)
    assert {r.fingerprint for r in got if r.n_chars == 0} == {"0" * 32}
    one = op4.edited_fingerprints(docs(spark, [(4, "abcd")])).first()
    assert (one.edited_sha256, one.near_next) == (hashlib.sha256(b"abab").hexdigest(), 1.0)
    assert op4.edited_fingerprints(docs(spark, [])).count() == 0
    both = op4.edited_fingerprints(docs(spark, [(1, "same text here"), (2, "same text here")])).collect()
    assert len({r.fingerprint for r in both}) == 1


def check_ring(got, pairs):
    """Each row's edited text takes its end from the row after it: by falling id, null last, ties in one fixed order."""
    sha = lambda t, after: hashlib.sha256((t[: len(t) - len(t) // 2] + after[: len(t) // 2]).encode()).hexdigest()
    ids = sorted({d for d, _ in pairs if d is not None}, reverse=True) + [None] * any(d is None for d, _ in pairs)
    of = {d: Counter(t or "" for e, t in pairs if e == d) for d in ids}
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((r.n_chars, r.edited_sha256))
    assert {d: len(x) for d, x in found.items()} == {d: sum(x.values()) for d, x in of.items()}
    for i, d in enumerate(ids):
        # a chain through the rows of this id, whose last one goes on with some row of the next id
        nexts = set(of[d]) | set(of[ids[(i + 1) % len(ids)]])
        possible = {(len(t), sha(t, n)): t for t in of[d] for n in nexts}
        assert Counter(possible[x] for x in found[d]) == of[d]
        if len(of[d]) == 1 and len(of[ids[(i + 1) % len(ids)]]) == 1 and of[d].total() == 1:
            t, n = next(iter(of[d])), next(iter(of[ids[(i + 1) % len(ids)]]))
            assert found[d] == [(len(t), sha(t, n))]


def test_fingerprints_of_repeated_and_null_ids(spark):
    """A third of all rows has one id, a third none; their buckets are cut by the text."""
    rng = random.Random(3)
    word = lambda i: " ".join(f"{rng.choice('abcdef')}{i}{k}" for k in range(6))
    pairs = [(50, word(i)) for i in range(150)] + [(None, word(1000 + i)) for i in range(150)] + [(i, word(2000 + i)) for i in range(150) if i != 50]
    df = docs(spark, pairs).withColumns({"bucket": F.lit(1), "top": F.lit(2), "above": F.lit(3), "copy": F.lit(4), "order": F.lit(5)})
    got = op4.edited_fingerprints(df).collect()
    check_ring(got, pairs)
    again = op4.edited_fingerprints(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    dealt = Counter(r[0] for r in op4.edited_fingerprints(df).select(F.spark_partition_id()).collect())
    assert len(dealt) == 4 and max(dealt.values()) < 300
    check_ring(op4.edited_fingerprints(docs(spark, EDGE)).collect(), EDGE)


def test_fingerprints_do_not_depend_on_partitions(spark):
    """Rows that repeat an id have one order, whether an id spans buckets or not."""
    rows = [(i, f"text {i} of some words") for i in range(50)] + [(2, f"copy {i} of id two") for i in range(3)] + [(7, "seven again"), (7, "seven once more")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for parts in ("1", "4", "211"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got.append(sorted(map(repr, op4.edited_fingerprints(docs(spark, rows)).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1] == got[2]


def test_simhash_by_definition():
    """Votes of each distinct triple of words, one bit at a time."""
    simhash = op4.SimHash()
    for t in ("a b c d a b c", "one", "x y", "", "w " * 40 + "v"):
        votes = [0.0] * op4.BITS
        terms, counts = simhash.terms(t)
        words = t.split()
        grams = Counter(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else Counter()
        assert sorted(counts.tolist()) == sorted(grams.values())
        for term, n in zip(terms, counts):
            raw = b"".join(int(op4._mixed(np.array([term]), k)[0]).to_bytes(8, "little") for k in (2, 4))
            for b in range(op4.BITS):
                votes[b] += (1 + math.log(n)) * (1 if raw[b // 8] >> (7 - b % 8) & 1 else -1)
        want = sum((v > 1e-3) << (op4.BITS - 1 - b) for b, v in enumerate(votes))
        assert int(simhash.of(t).hex(), 16) == want


def test_within_radius(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(128) for _ in range(60)]
    for p in prints[:40]:
        for _ in range(2):
            q = p
            for b in rng.sample(range(128), rng.randint(0, 9)):
                q ^= 1 << b
            prints.append(q)
    df = spark.createDataFrame([(f"{p:032x}",) for p in [*prints, *prints[:5]]] + [(None,)], "fingerprint string")
    for radius, blocks in ((6, 8), (3, 6)):
        got = {(r.a, r.b, r.distance) for r in op4.within_radius(df, radius=radius, blocks=blocks).collect()}
        want = {(*sorted((f"{a:032x}", f"{b:032x}")), (a ^ b).bit_count()) for a, b in combinations(set(prints), 2) if (a ^ b).bit_count() <= radius}
        assert got == want


# ---- near duplicates ----------------------------------------------------------------------------


def word_set(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(pairs):
    sets = [word_set(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(pairs)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(pairs)}


def got_components(df):
    rows = op9.near_duplicates(df).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_shingle_sets():
    texts = ["", " ", "a", "A bÉ c d", "a b c d e", "A  b c\td e f a b c d e", "x\x1cy z"]
    for t, s in zip(texts, op9.shingle_sets(pa.array(texts))):
        assert len(s) == len(word_set(t))
    a, b = op9.shingle_sets(pa.array(["One two\nthree", "one TWO three"]))
    assert (a == b).all()


def test_threshold_is_exact():
    words = [f"w{i}" for i in range(500)]
    for k in range(60, 80):
        x, y = words[: 4 + 100], words[100 - k : 4 + 100 - k + 100]
        a, b = op9.shingle_sets(pa.array([" ".join(x), " ".join(y)]))
        i, u = len(word_set(" ".join(x)) & word_set(" ".join(y))), len(word_set(" ".join(x)) | word_set(" ".join(y)))
        assert op9.linked(a, b) == (100 * i >= 75 * u)


def test_components_of_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got_components(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def edited(rng, words, share):
    return [rng.choice(words) if rng.random() < share else w for w in words]


def test_large_groups_branch(spark, monkeypatch):
    """A hot group, a passage that unrelated texts share, and a chain, with nodes small enough to need every path."""
    for name, value in (("NODE_ROWS", 6), ("REST_ROWS", 5), ("MEMBER_ROWS", 8), ("HOT_SETS", 2)):
        monkeypatch.setattr(op9, name, value)
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    pairs = [(i, " ".join(edited(rng, base, rng.choice([0.005, 0.01, 0.03])))) for i in range(90)]
    pairs += [(100 + i, " ".join(passage + [rng.choice(vocabulary) for _ in range(40)])) for i in range(40)]
    chain = [rng.choice(vocabulary) for _ in range(200)]
    pairs += [(200 + i, " ".join(chain[3 * i : 3 * i + 80])) for i in range(30)]
    rng.shuffle(pairs)
    assert got_components(docs(spark, pairs)) == brute(pairs)


def test_lobes_that_a_thin_bridge_connects(spark, monkeypatch):
    """Two large clusters that meet only between a class near the one and a class near the other."""
    for name, value in (("NODE_ROWS", 6), ("REST_ROWS", 5), ("MEMBER_ROWS", 8), ("HOT_SETS", 2)):
        monkeypatch.setattr(op9, name, value)
    pairs = []
    for g in range(8):
        words = [f"g{g}w{i}" for i in range(220)]
        window = lambda at, *more: " ".join([*words[at : at + 144], *more])
        texts = [window(0, f"g{g}x{i}") for i in range(20)] + [window(18), window(36)] + [window(54, f"g{g}y{i}") for i in range(20)]
        pairs += [(100 * g + i, t) for i, t in enumerate(texts)]
    want = brute(pairs)
    assert len({c for _, c in want.values()}) == 8
    assert got_components(docs(spark, pairs)) == want


def node_join_rows(spark, after):
    """Rows made by all inner joins on the node alone, in the executions after `after`; and the last execution."""
    store = spark._jsparkSession.sharedState().statusStore()
    found, last = 0, after
    executions = store.executionsList()
    for i in range(executions.size()):
        at = executions.apply(i).executionId()
        if at <= after:
            continue
        last = max(last, at)
        values, nodes = store.executionMetrics(at), store.planGraph(at).allNodes()
        for j in range(nodes.size()):
            node = nodes.apply(j)
            if re.search(r"Join \[node#\d+L?\], \[node#\d+L?\], Inner", node.desc()):
                of = {(m := node.metrics().apply(k)).name(): m.accumulatorId() for k in range(node.metrics().size())}
                value = values.get(of["number of output rows"])
                found += int(value.get().replace(",", "")) if value.isDefined() else 0
    return found, last


def test_a_level_joins_its_members_with_their_signatures_once(spark, monkeypatch):
    for name, value in (("NODE_ROWS", 6), ("REST_ROWS", 5), ("MEMBER_ROWS", 8), ("HOT_SETS", 2), ("LEVELS", 3)):
        monkeypatch.setattr(op9, name, value)
    monkeypatch.setattr(op9, "_linkable", lambda members, sets, rows: members)  # these classes would leave on the first level
    counts = Counter()

    def counted(name, count):
        made = getattr(op9, name)

        def wrapped(first, *more):
            out = made(first, *more)
            counts.update(count(first, out))
            return out

        monkeypatch.setattr(op9, name, wrapped)

    counted("_members", lambda state, out: {"large": out.where(f"size > {op9.NODE_ROWS}").count(), "small": out.where(f"size <= {op9.NODE_ROWS}").count(), "levels": 1})
    counted("_rest_links", lambda few, out: {"rest": few.count()})
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    pairs = [(i, " ".join(passage + [rng.choice(vocabulary) for _ in range(40)])) for i in range(60)]
    pairs += [(200 + i, " ".join(edited(rng, passage * 2, 0.01))) for i in range(30)]
    before = node_join_rows(spark, -1)[1]
    assert got_components(docs(spark, pairs)) == brute(pairs)
    rows = node_join_rows(spark, before)[0]
    assert counts["levels"] == 3
    # and each class twice: for its words, and for the name of its component
    assert 0 < rows <= counts["large"] + counts["rest"] + counts["small"] + 2 * len(pairs), (rows, counts)


def test_unlinked_texts_of_one_passage_leave_the_branching(spark, monkeypatch):
    """Similarity 0.70 everywhere: nothing is linked, and no second level is made. Some larger links stay."""
    for name, value in (("NODE_ROWS", 6), ("REST_ROWS", 5), ("MEMBER_ROWS", 8), ("HOT_SETS", 2)):
        monkeypatch.setattr(op9, name, value)
    levels, made = [], op9._members
    monkeypatch.setattr(op9, "_members", lambda state, rows: levels.append(rows) or made(state, rows))
    passage = [f"p{i}" for i in range(60)]
    pairs = [(i, " ".join(passage + [f"a{i}x{j}" for j in range(12)])) for i in range(120)]
    assert got_components(docs(spark, pairs)) == brute(pairs)
    assert levels == [6 * 120]
    # texts with few words of their own are linked with those of up to 12; those of more are linked with none of these
    rng = random.Random(3)
    pairs = [(i, " ".join([f"a{i}x{j}" for j in range(rng.randint(4, 26))] + passage)) for i in range(120)]
    want = brute(pairs)
    assert 10 < len({c for _, c in want.values()}) < 110
    assert got_components(docs(spark, pairs)) == want


def test_prefixes_find_every_link():
    """Of each linked pair, the first common shingle is in both prefixes, in the smaller set's first part and below both caps."""
    rng = random.Random(4)
    counts = np.array([rng.randrange(5) for _ in range(op9.COUNT_CELLS)])
    for _ in range(300):
        base = [f"w{i}" for i in range(rng.randint(5, 60))]
        texts = [" ".join(edited(rng, base, rng.choice([0, 0.02, 0.05])) + [f"e{k}" for _ in range(rng.randint(0, 8))]) for k in range(2)]
        x, y = sorted(op9.shingle_sets(pa.array(texts)), key=len)
        if not op9.linked(x, y):
            continue
        packer = zstandard.ZstdCompressor()
        batch = pa.RecordBatch.from_pydict({"node": [0, 1], "label": [0, 1], "words": [packer.compress(t.encode()) for t in texts]})
        rows = {}
        for out in op9._prefixes(counts)([batch]):
            for r in out.to_pylist():
                rows.setdefault(r["size"] if len(x) != len(y) else r["node"], []).append(r)
        small, large = (rows[k] for k in (sorted(rows)))
        at = {r["token"]: r for r in large}
        first = next(r for r in small if r["token"] in at)
        other = at[first["token"]]
        assert first["first"] and other["size"] <= first["cap"] and first["size"] <= other["cap"]


def test_the_filter_keeps_every_shared_shingle():
    """Over several tasks, batches and flushes: all tokens of two sets stay, also in a full filter; of the others most go in a wide one."""
    rng = np.random.default_rng(6)
    shared = rng.integers(0, 1 << 63, 300, np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(shared, 6, replace=False), rng.integers(1 << 63, (1 << 64) - 1, 20, np.uint64)])) for _ in range(400)]
    times = Counter(x for s in sets for x in s.tolist())
    alone = sum(n == 1 for n in times.values())
    for marks, most in ((op9.BLOCK_MARKS, 0.2), (4 * op9.BLOCK_MARKS, 0.06)):
        found = {}
        for task in range(4):
            own = [s.tobytes() for s in sets[task::4]]
            batches = [pa.RecordBatch.from_pydict({"tokens": own[i : i + 30]}) for i in range(0, len(own), 30)]
            for out in op9._marked(marks)(batches):
                for r in out.to_pylist():
                    found.setdefault(r["block"], []).append(r)
        bits = np.zeros((marks // op9.BLOCK_MARKS, op9.BLOCK_MARKS // 8), np.uint8)
        for block, rows in found.items():
            (r,) = op9._hit_twice(pa.Table.from_pylist(rows)).to_pylist()
            bits[r["block"]] = np.frombuffer(r["bits"], np.uint8)
        batch = pa.RecordBatch.from_pydict({"node": range(400), "label": range(400), "size": [100] * 400, "tokens": [s.tobytes() for s in sets]})
        kept = [(r["node"], r["token"] % (1 << 64)) for out in op9._shared(bits.reshape(-1))([batch]) for r in out.to_pylist()]
        assert len(kept) == len(set(kept))
        assert {(i, x) for i, s in enumerate(sets) for x in s.tolist() if times[x] > 1} <= set(kept)
        assert sum(times[x] == 1 for _, x in kept) < most * alone


def prefix_rows(monkeypatch):
    """The rows of each table of prefixes that is written from here on."""
    rows, written = [], op9.materialise

    def counted(df, name, *more, **options):
        out = written(df, name, *more, **options)
        if name == "prefixes":
            rows.append(out.count())
        return out

    monkeypatch.setattr(op9, "materialise", counted)
    return rows


def test_shingles_of_one_text_make_no_rows(spark, monkeypatch):
    """Similarity 0.70 everywhere: of the 18 rarest shingles of a text 12 are its own, and only 6 can be another's."""
    for name, value in (("NODE_ROWS", 6), ("REST_ROWS", 5), ("MEMBER_ROWS", 8), ("HOT_SETS", 2)):
        monkeypatch.setattr(op9, name, value)
    rows = prefix_rows(monkeypatch)
    passage = [f"p{i}" for i in range(60)]
    pairs = [(i, " ".join(passage + [f"a{i}x{j}" for j in range(12)])) for i in range(120)]
    assert got_components(docs(spark, pairs)) == brute(pairs)
    assert len(rows) == 1 and 6 * 120 <= rows[0] <= 7 * 120, rows


def test_the_pipelines_near_copies_make_few_rows(spark, monkeypatch):
    """The stage keeps all of these texts, as none is linked, and the shingles of one text alone make no rows."""
    for name, value in (("NODE_ROWS", 6), ("REST_ROWS", 5), ("MEMBER_ROWS", 8), ("HOT_SETS", 2)):
        monkeypatch.setattr(op9, name, value)
    rows = prefix_rows(monkeypatch)
    passage = [f"p{i}" for i in range(60)]
    df = docs(spark, [(i, " ".join(passage + [f"a{i}x{j}" for j in range(12)])) for i in range(100)])
    before = spark.conf.get(corpus_pipeline._BATCH_KEY)
    try:
        kept = corpus_pipeline.near_dedup(spark, df, "")
        assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == list(range(100))
    finally:
        spark.conf.set(corpus_pipeline._BATCH_KEY, before)
    assert len(rows) == 1 and 6 * 100 <= rows[0] <= 7 * 100, rows


def test_near_edges(spark):
    pairs = [(d, t) for d, t in EDGE if d is not None and (d, t) != (8, "a b")] + [(8, "a b"), (20, "One two"), (21, "one  TWO"), (22, "one two three")]
    assert got_components(docs(spark, pairs)) == brute(pairs)
    rows = op9.near_duplicates(docs(spark, [*EDGE, (1, "other words are here now")])).collect()
    assert len(rows) == len(EDGE) + 1
    assert sorted(r.component_id for r in rows if r.doc_id == 8) == [1, 1]
    assert op9.near_duplicates(docs(spark, [])).count() == 0
    assert op9.near_duplicates(docs(spark, [(None, "a b c"), (None, "a b c")])).where("kept").count() == 2


def test_kept_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({"node": F.lit(1), "__gone": F.lit(2)})
    want = {d for d, (_, c) in brute([(r.doc_id, r.text) for r in df.collect()]).items() if d == c}
    kept = op9.kept_documents(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == want


def test_kept_documents_are_rows(spark):
    """Ids that repeat with different texts, and null ids: one row of each component stays."""
    a, b, c, e = (" ".join(f"{k}{i}" for i in range(60)) for k in "abce")
    rows = [(1, a), (5, a + " more"), (5, b), (6, b + " more"), (None, c), (None, c + " more"), (None, c.upper()), (7, e), (7, e.upper()), (7, e + " more"), (9, ""), (9, ""), (None, None), (10, "alone")]
    texts = [r.text for r in op9.kept_documents(docs(spark, rows)).collect()]
    first = [t.lower().split()[0] if t else "" for t in texts]
    assert sorted(first) == ["", "", "", "a0", "alone", "b0", "c0", "e0"]


@pytest.mark.parametrize("small", [0, 2, 500_000])
def test_graph_components(spark, small):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(12)] + [(200, 201 + i) for i in range(30)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    got = {r.node: r.root for r in op9.components(spark.createDataFrame(edges, "a long, b long"), small).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert set(got) == nodes
    assert all((got[a] == got[b]) == (find(a) == find(b)) for a, b in combinations(sorted(nodes), 2))
