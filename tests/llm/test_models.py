"""Language identification, PPM scores, WARC archives and the pipeline."""

import gzip
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from vitalgrain.llm import op5_language as op5
from vitalgrain.llm import op6_exact_dedup as op6
from vitalgrain.llm import op8_lm_scoring as op8
from vitalgrain.llm import op10_warc as op10
from vitalgrain.llm.op3_packing import pack

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


# ---- language -----------------------------------------------------------------------------------


def test_language_held_out(spark, sf_dir):
    rows = op5.op5_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    train = [(i, f"the cat and the dog number {i}" if i % 2 else f"le chat et le chien {i}", "en" if i % 2 else "fr", "s", 1) for i in range(60)]
    edges = [(100, None, "en", "s", 1), (101, "", None, "s", 1), (102, "123 .,!", "en", "s", 1), (103, "the cat", None, "s", 1), (None, "le chien", " ", "s", 1), (104, "chat " * 50_000, "fr", "s", 1), (103, "the cat", None, "s", 1), (105, "日本語", "en", "s", 1)]
    df = spark.createDataFrame(train + edges, SCHEMA).withColumn("__language", F.lit(1))
    rows = op5.with_language(df).where("doc_id >= 100 or doc_id is null").collect()
    got = Counter((r.doc_id, r.lang_pred) for r in rows)
    assert got == Counter({(100, "und"): 1, (101, "und"): 1, (102, "und"): 1, (103, "en"): 2, (None, "fr"): 1, (104, "fr"): 1, (105, "en"): 1})
    assert rows[0].__fields__[:6] == [*df.columns]
    kept = op5.identified(df)
    assert kept.columns == df.columns
    assert {100, 101, 102}.isdisjoint({r.doc_id for r in kept.collect()})
    none = spark.createDataFrame([], SCHEMA)
    assert op5.with_language(none).count() == 0
    assert [r.lang_pred for r in op5.with_language(spark.createDataFrame([(1, "words", None, "s", 1)], SCHEMA)).collect()] == ["und"]


def test_languages_are_learned_whatever_the_ids(spark):
    """Null ids, and few of them, don't decide the sample alone, and its size keeps near its bound."""
    from vitalgrain.llm import op5_language as op5

    for ids in ("cast(null as long)", "id % 3"):
        rows = spark.range(20_000).selectExpr(f"{ids} as doc_id", "case when id % 2 = 0 then concat('the house and the garden number ', id) else concat('das haus und der garten nummer ', id) end as text", "case when id % 2 = 0 then 'en' else 'de' end as lang")
        model = op5.fit(rows, sample_rows=500)
        assert sorted(model.langs) == ["de", "en"]


def test_languages_that_were_not_learned_go(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    foreign = F.col("lang") == "de"
    mixed = df.withColumn("foreign", foreign).withColumn("lang", F.when(~F.col("foreign"), F.col("lang")))
    own, rest = mixed.where("not foreign"), mixed.where("foreign")
    kept = op5.identified(mixed)
    assert rest.count() >= 10
    assert kept.where("foreign").count() <= 0.1 * rest.count()
    assert kept.where("not foreign").count() == own.where(r"text rlike '\\p{L}'").count()


def test_repeated_words_are_no_other_language():
    counts = [("a", 0, w, 100) for w in ("uno", "dos", "tres")] + [("a", n, g, 100) for w in ("uno", "dos", "tres") for n in (1, 2, 3, 4) for g in op5.grams_of(w, n)]
    found = op5.Predictor(op5.Model(counts)).found
    assert op5.distinct_words("a A b b") == 2 and op5.distinct_words("") == 1
    foreign = " ".join("tu" + a + b for a in "abcdefgh" for b in "abcdefgh")
    texts = ["unos " * 500, foreign, "uno dos tres " * 30, "", "12 34"]
    assert [sure for *_, sure in found(pa.array(texts))] == [True, False, True, False, False]


TOY = [("a", 0, "known", 9), ("b", 0, "known", 1), ("a", 0, "more", 1), ("b", 0, "other", 19), ("a", 3, "^xy", 1), ("b", 3, "^xy", 9), ("a", 3, "zzz", 9), ("b", 3, "yyy", 1), ("a", 1, "q", 9), ("b", 1, "q", 1), ("a", 1, "r", 1), ("b", 1, "r", 9)]


def test_backoff_goes_from_words_to_shorter_grams():
    model = op5.Model(TOY)
    share = lambda w: [round(math.exp(x), 2) for x in model.word(w)]
    assert share("known")[0] > 0.5 > share("xyz")[0]
    assert share("q")[0] > 0.5 > share("r")[0] and model.word("w") is None


def plain_language(counts, text, longest=4):
    """The prediction by its definition: sums over the words of log shares, and of shares."""
    langs = sorted({lang for lang, *_ in counts})
    table, total = defaultdict(lambda: dict.fromkeys(langs, 0)), defaultdict(lambda: dict.fromkeys(langs, 0))
    for lang, size, item, n in counts:
        table[size, item][lang] += n
        total[size][lang] += n

    def shares(freqs):
        whole = sum(freqs.values())
        return {k: math.log(max(v / whole, math.exp(-12))) for k, v in freqs.items()}

    def item(size, x):
        if (size, x) not in table:
            return None
        return shares({k: n / max(total[size][k], 1) + 0.2 / max(total[size].values()) for k, n in table[size, x].items()})

    words = op5.words_of(text or "")
    if not words:
        return "und", 0.0
    logs, means = dict.fromkeys(langs, 0.0), dict.fromkeys(langs, 0.0)
    for w in words:
        found = item(0, w)
        for size in range(longest, 0, -1):
            if found is None:
                grams = [g for g in (item(size, g) for g in op5.grams_of(w, size)) if g]
                found = shares({k: math.exp(sum(g[k] for g in grams)) for k in langs}) if grams else None
        for k, x in (found or {}).items():
            logs[k] += x
            means[k] += math.exp(x) / len(words)
    best = max(langs, key=lambda k: (logs[k], [-ord(c) for c in k]))
    return best, means[best]


def test_language_by_definition(spark, sf_dir):
    """Every text of the smallest table, with the counts that the fit gives; and the toy model."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learned = []
    original = op5.Model.__init__

    class Seen(op5.Model):
        def __init__(self, counts, least_count=2):
            learned.append(counts)
            original(self, counts, least_count)

    op5.Model, kept = Seen, op5.Model
    try:
        model = op5.fit(rows.where(op5.fold("doc_id", 3) != 1), sample_rows=40)
    finally:
        op5.Model = kept
    for counts, texts in ((learned[0], [r.text for r in rows.collect()]), (TOY, ["known xyz q r w", "KNOWN, other", "zzz", "", None, "12", "xyz xyz"])):
        got = op5.Predictor(op5.Model(counts))(pa.array(texts, pa.string()))
        for t, (lang, score) in zip(texts, got):
            want = plain_language(counts, t)
            assert (lang, score) == (want[0], pytest.approx(want[1], abs=2e-4)), t
    assert model.langs == sorted({c[0] for c in learned[0]})


def test_slices_change_nothing(monkeypatch):
    model = op5.Model([("a", 0, "x", 5), ("b", 0, "x", 2), ("a", 1, "y", 1), ("b", 1, "y", 5)])
    texts = pa.array([None, "", *(" ".join(f"x{i} y{i} x" for i in range(k, k + 7)) for k in range(40))])
    whole = op5.Predictor(model)(texts)
    monkeypatch.setattr(op5, "SLICE_BYTES", 64)
    assert [(a, round(b, 5)) for a, b in op5.Predictor(model)(texts)] == [(a, round(b, 5)) for a, b in whole]


# ---- PPM ----------------------------------------------------------------------------------------


class Trie:
    """The model by its definition."""

    def __init__(self, order):
        self.order, self.seen = order, defaultdict(Counter)

    def learn(self, text):
        p = b"\n" * self.order + text
        for i in range(self.order, len(p)):
            for k in range(self.order + 1):
                self.seen[p[i - k : i]][p[i]] += 1

    def distribution(self, context):
        out, mass, excluded = {}, 1.0, set()
        for k in range(self.order, -1, -1):
            counts = {a: n for a, n in self.seen.get(context[len(context) - k :], {}).items() if a not in excluded}
            if counts:
                total = 2 * sum(counts.values())
                out.update({a: mass * (2 * n - 1) / total for a, n in counts.items()})
                mass *= len(counts) / total
                excluded |= set(counts)
        return out | {a: mass / (256 - len(excluded)) for a in range(256) if a not in excluded}

    def log10(self, text):
        p = b"\n" * self.order + text
        return sum(math.log10(self.distribution(p[i - self.order : i])[p[i]]) for i in range(self.order, len(p)))


def normal(t):
    words = (t or "").encode().lower().split()
    return words, b" ".join(words) + b"\n"


ROWS = [(1, "the cat sat"), (2, None), (3, ""), (4, "The  CAT\tran\x0b"), (5, "é É"), (None, "no id"), (6, "the cat sat"), (6, "the cat sat"), (7, " \n "), (8, "unseen zebra\x1cx"), (9, "ab " * 3000), (12, "quite other words")]


def check_scores(rows, pairs, order):
    trie, count = Trie(order), Counter()
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    for d, t in pairs:
        if not held(d):
            words, whole = normal(t)
            trie.learn(whole)
            count.update([*words, "end"])
    total, distinct = sum(count.values()), len(count)
    want = []
    for d, t in pairs:
        words, whole = normal(t)
        tokens = [*words, "end"]
        base = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in tokens)
        want.append((str(d), held(d), len(tokens), sum(count[w] > 0 for w in tokens), total, pytest.approx(base), pytest.approx(trie.log10(whole))))
    got = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows), key=lambda x: (x[0], x[6]))
    assert got == sorted(want, key=lambda x: (x[0], x[6].expected))


@pytest.mark.parametrize(("order", "head"), [(1, 0), (3, 4), (5, 1000)])
def test_scores_by_definition(spark, order, head):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({"row": F.lit(1), "tail": F.lit(2)})
    check_scores(op8.scores(df, order=order, head_words=head).collect(), ROWS, order)


@pytest.mark.parametrize(("order", "most", "rows_at_once"), [(2, 0, 1), (3, 10, 5), (5, 60, 300_000), (6, 20, 7)])
def test_grams_that_are_not_broadcast_count_in_full(spark, monkeypatch, order, most, rows_at_once):
    monkeypatch.setattr(op8, "SOLVE_ROWS", rows_at_once)
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    check_scores(op8.scores(df, order=order, max_grams=most).collect(), ROWS, order)


def test_long_words_are_joined(spark):
    rows = [*ROWS, *((d, f"{'long' * 20}  the {'x' * 5000}") for d in range(20, 32)), (32, "y" * 64), (33, "z" * 65)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_scores(op8.scores(df, order=3).collect(), rows, 3)


@pytest.mark.parametrize("held", [1, 40, 4_000_000])
def test_a_task_holds_a_bounded_number_of_counts(monkeypatch, held):
    monkeypatch.setattr(op8, "HELD_GRAMS", held)
    monkeypatch.setattr(op8, "GRAM_SLICE", 30)
    texts = ["the cat sat", "", "éa" * 20, "the cat ran", "the cat sat"] * 3
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 4])], ["text"]) for i in range(0, len(texts), 4)]
    found = Counter()
    for batch in op8._count(2)(iter(batches)):
        for r in batch.to_pylist():
            if r["gram"] is not None:
                found[r["gram"]] += r["n"]
    want = Counter()
    for text in texts:
        line = b"\n\n" + text.encode() + b"\n"
        want.update(int.from_bytes(line[i : i + 3], "big") for i in range(len(line) - 2))
    assert found == want


def test_scores_edges(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert op8.scores(df.limit(0)).count() == 0
    held = [d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2][:3]
    nothing = op8.scores(spark.createDataFrame([(d, "abc") for d in held], "doc_id long, text string")).collect()
    assert [(r.train_tokens, r.n_known) for r in nothing] == [(0, 0)] * 3
    assert all(r.score == pytest.approx(-4 * math.log10(256)) and r.base_score == 0 for r in nothing)


def test_scores_beat_chance_on_held_out(spark, sf_dir):
    rows = [r for r in op8.op8_lm_scoring(spark, sf_dir).collect() if r.held_out]
    size = sum(len(normal(r.text)[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    assert -sum(r.score for r in rows) / size < math.log10(256) / 2.5


def test_distribution_sums_to_one():
    text = b"abracadabra abc\n"
    grams, counts = np.unique(op8._grams(op8._words(pa.array([text.decode().strip()]))[2], 2)[0], return_counts=True)
    ppm = op8.Ppm(grams, counts, 2)
    for context in (b"ab", b"zz", b"\n\n", b"ra", b"a "):
        codes = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert (10 ** ppm.logs(codes)).sum() == pytest.approx(1)


def test_a_smaller_trie_is_still_a_distribution(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    few = op8.scores(df, order=3, max_grams=10).collect()
    assert all(math.isfinite(r.score) and r.score < 0 for r in few)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=200), st.lists(st.integers(0, 300), max_size=50))
def test_table(keys, others):
    table = op8.Table(np.array(keys, np.uint64), np.arange(len(keys), dtype=np.int64))
    want = {k: i for i, k in enumerate(keys)}
    asked = keys + others
    assert table.get(np.array(asked, np.uint64), -1).tolist() == [want.get(k, -1) for k in asked]


# ---- WARC ---------------------------------------------------------------------------------------

LONG = "<p>" + "é" * 1000
PAGES = [(1, "http://a/1", LONG), (5, "http://a/5", LONG), (3, None, LONG), (5, "http://a/5", LONG), (None, "http://a/n", LONG), (6, "http://a/ 6\r\nX: y", "short"), (7, "u", "short"), (8, "u", None), (9, "u", ""), (10, "u", "x" * 999), (11, "u", "x" * 999), (12, "u", "y" * 200_000), (13, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (None, "u", "z" * 1000), (None, "u", "z" * 1000), (14, "u", "\r\n\r\nWARC/1.0\r\n")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"sha": F.lit(1), "size": F.lit(1), "copies": F.lit(1)})


def test_archives(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    op10.write_archives(pages(spark), path, archive_bytes=4096)
    rows = op10.read_archives(spark, path, payloads=True)
    assert rows.where("reason is not null").count() == 0
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes, r.payload_digest) for r in op10.resolved(rows).collect())
    want = []
    for p, _, h in PAGES:
        body = (h or "").encode()
        first = max((q for q, _, x in PAGES if (x or "") == (h or "") and q is not None), default=None) if len(body) >= 1000 else p
        revisit = len(body) >= 1000 and first is not None and p != first
        want.append((str(p), "revisit" if revisit else "response", str(first if revisit else None), len(body), hashlib.sha1(body).hexdigest()))
    assert got == sorted(want)
    bodies = {r.page_id: r.payload for r in rows.where("record_type = 'response'").collect()}
    assert bytes(bodies[12]).decode() == "y" * 200_000 and bytes(bodies[13]).startswith(b"WARC/1.1")
    assert {r.url for r in rows.where("page_id = 6").collect()} == {"http://a/%206%0D%0AX:%20y"}


def test_revisits_of_a_page_id_with_two_payloads(spark, tmp_path):
    """Each revisit has the size and digest of its own payload."""
    a, b = "a" * 1000, "b" * 2500
    pages = spark.createDataFrame([(5, "u", a), (5, "u", b), (3, "u", a), (4, "u", b), (5, "u", b), (2, "u", "short")], "page_id long, url string, html string")
    op10.write_archives(pages, str(tmp_path / "w"))
    got = sorted((r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in op10.resolved(op10.read_archives(spark, str(tmp_path / "w"))).collect())
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    want = [(2, "response", 5, sha("short"), None), (3, "revisit", 1000, sha(a), 5), (4, "revisit", 2500, sha(b), 5), (5, "response", 1000, sha(a), None), (5, "response", 2500, sha(b), None), (5, "response", 2500, sha(b), None)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_archives_of_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    op10.write_archives(pages(spark, []), path)
    assert op10.resolved(op10.read_archives(spark, path)).count() == 0


def test_damaged_archives(spark, tmp_path, caplog):
    """A damaged file costs only the records that the damage touches; the rest is read, the gap is written and logged."""
    path = tmp_path / "w"
    op10.write_archives(pages(spark), f"file://{path}", archive_bytes=4096)
    files = sorted(path.glob("part-*"))
    hurt = next(f for f in files if b"<urn:page:12>" in f.read_bytes())
    data = bytearray(hurt.read_bytes())
    data[data.index(b"yyyy") + 5] ^= 1
    hurt.write_bytes(data)
    for f in path.glob(".*.crc"):
        f.unlink()
    with caplog.at_level("WARNING"):
        found, gaps = op10.quarantined(op10.read_archives(spark, f"file://{path}"))
    assert {r.page_id for r in found.collect()} == {p for p, _, _ in PAGES} - {12}
    gap = gaps.collect()
    assert [r.reason for r in gap] == ["block digest differs"] and "quarantined 1 gaps" in caplog.text
    assert bytes(data[gap[0].offset : gap[0].offset + gap[0].length]).startswith(b"WARC/1.1")


def test_archives_close_by_their_bytes(spark, tmp_path):
    """Large pages together among small ones do not make a large archive."""
    rows = [(i, "u", f"{i:05}" * (20_000 if 300 <= i < 320 else 20)) for i in range(600)]
    op10.write_archives(pages(spark, rows).coalesce(1), f"file://{tmp_path}/w", archive_bytes=250_000)
    sizes = [f.stat().st_size for f in (tmp_path / "w").glob("part-*")]
    assert len(sizes) >= 10 and max(sizes) <= 250_000
    assert op10.read_archives(spark, f"file://{tmp_path}/w").where("reason is null").count() == 600


def records(n=6):
    bodies = [f"<html>{i} " + "text " * (50 * i) + "</html>" for i in range(n)]
    return [op10.record_text(i, f"http://x/{i}", b, hashlib.sha1(b.encode()).digest(), None) for i, b in enumerate(bodies)]


@pytest.mark.parametrize("zipped", [False, True])
def test_salvage(zipped):
    parts = [op10.member(r) if zipped else (r + op10.END).encode() for r in records()]
    ends = [sum(map(len, parts[: i + 1])) for i in range(len(parts))]
    whole = b"".join(parts)
    ids = lambda data: [x.headers["warc-record-id"] for x in op10.salvage(data) if isinstance(x, op10.Record)]
    gaps = lambda data: [(x.offset, x.length) for x in op10.salvage(data) if isinstance(x, op10.Gap)]
    all_ids = [f"<urn:page:{i}>" for i in range(6)]
    assert ids(whole) == all_ids and gaps(whole) == []
    # one byte of the third record differs
    at = ends[1] + len(parts[2]) // 2
    broken = whole[:at] + bytes([whole[at] ^ 0x55]) + whole[at + 1 :]
    assert ids(broken) == all_ids[:2] + all_ids[3:] and gaps(broken) == [(ends[1], len(parts[2]))]
    # bytes lost at the start, in the middle and at the end
    assert ids(whole[7:]) == all_ids[1:] and gaps(whole[7:])[0][0] == 0
    assert ids(whole[: ends[2] + 5] + whole[ends[3] :]) == all_ids[:3] + all_ids[4:]
    assert ids(whole[:-9]) == all_ids[:5] and gaps(whole[:-9]) == [(ends[4], len(parts[5]) - 9)]
    # junk between two records
    junk = whole[: ends[0]] + b"\x1f\x8b\x08junk WARC/1.0" + whole[ends[0] :]
    assert ids(junk) == all_ids and len(gaps(junk)) == 1
    assert ids(b"") == [] and gaps(b"") == [] and gaps(b"nothing") == [(0, 7)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 300), st.booleans(), st.booleans())
def test_salvage_accounts_for_all_bytes(at, n, zipped, cut):
    parts = [op10.member(r) if zipped else (r + op10.END).encode() for r in records(5)]
    whole = b"".join(parts)
    at %= len(whole)
    data = whole[:at] + whole[at + n :] if cut else whole[:at] + bytes(b ^ 0xA5 for b in whole[at : at + n]) + whole[at + n :]
    found = list(op10.salvage(data))
    assert sum(x.length for x in found) == len(data)
    start, safe = 0, set()
    for i, p in enumerate(parts):
        if start + len(p) <= at or start >= at + n:
            safe.add(f"<urn:page:{i}>")
        start += len(p)
    assert safe <= {x.headers["warc-record-id"] for x in found if isinstance(x, op10.Record)}


def test_header_of_another_length_does_not_swallow_records():
    parts = records(4)
    wrong = parts[1].replace("Content-Length: ", "Content-Length: 9", 1)
    data = "".join(r + op10.END for r in [parts[0], wrong, *parts[2:]]).encode()
    assert [x.headers["warc-record-id"] for x in op10.salvage(data) if isinstance(x, op10.Record)] == [f"<urn:page:{i}>" for i in (0, 2, 3)]


def test_members_with_several_records():
    data = gzip.compress("".join(r + op10.END for r in records(3)).encode())
    assert len(list(op10.salvage(data))) == 3


# ---- pipeline -----------------------------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at, ids = docs, [{r.doc_id for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf_dir)
        assert at.columns == docs.columns
        ids.append({r.doc_id for r in at.collect()})
    assert ids[0] >= ids[1] >= ids[2] > ids[3]
    exact = {r.doc_id for r in op6.duplicate_groups(docs.where(F.col("doc_id").isin(list(ids[1])))).where("kept").collect()}
    assert ids[2] == exact
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.collect()} == ids[3]
    assert sorted(packed.columns) == sorted(pack(docs).columns)


def test_pipeline_edges(spark, tmp_path):
    """Null, empty and very long texts, ties, repeated rows and ids, and an empty table."""
    long = "the cat and the dog went over the hill " * 20_000
    rows = [
        (1, None, "en", "s", 1), (2, "the cat and the dog", "en", "s", 1), (3, "the cat and the dog", "en", "s", 1), (4, "", "en", "s", 1), (5, "123", "en", "s", 1), (6, "the cat and the dog and the man", "en", "s", 1),
        (2, "the cat and the dog", "en", "s", 1), (6, "the man and the other cat", "en", "s", 1), (7, long, "en", "s", 1), (None, "the dog and the hill", "en", "s", 1), (8, "THE CAT\tand the  dog", None, None, None),
    ]
    for name, some in (("a", rows), ("b", [])):
        df = spark.createDataFrame(some, SCHEMA).withColumns({"sha": F.lit(1), "size": F.lit(2), "gone": F.lit(3), "found": F.lit(4), "cls": F.lit(5), "lang_pred": F.lit(6)})
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    pieces = corpus_pipeline.run(spark, f"file://{tmp_path}/a").collect()
    # of the rows with id 6 each text stays; 8 is a near copy of 2
    assert sorted(str(r.doc_id) for r in pieces if r.start == 0) == ["2", "6", "6", "7", "None"]
    assert sum(r.length for r in pieces if r.doc_id == 7) == next(r.doc_tokens for r in pieces if r.doc_id == 7)
    assert corpus_pipeline.run(spark, f"file://{tmp_path}/b").count() == 0
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
