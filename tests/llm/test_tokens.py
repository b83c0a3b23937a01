"""Token counts, the BPE codec and packing against the tokenizers library."""

import hashlib
import random
import zlib

import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitalgrain.llm import bpe, op1_token_counts, op2_bpe_codec, op3_packing

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
LIBRARY = {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}
#: Spaces of all kinds, controls, case pairs of several characters, combining marks, digits of other scripts, special strings.
ODD = [*" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0", " ", "​", "᠎", " ", "'s", "S", "Σ", "İ", "ı", "é", "é", "日", "กำ", "٣", "½", "\U0001f642", "﻿", "\x00", "A", "b", ".", ",", "<|", "|>", "12", "<|endoftext|>", "<|startoftext|>", "  ", "   ", "'LL"]
text = st.lists(st.sampled_from(ODD), max_size=25).map("".join)
ROWS = [(0, None, 5), (1, "", 5), (2, "Hello, World! it's 42  x", 5), (2, "Hello, World! it's 42  x", 5), (3, "a" * 50_000, 5), (4, "word " * 30_000, None), (None, "null id", 5), (5, "<|endoftext|> x <|startoftext|>", 5), (6, " \n\t ", 5)]


def ids(path, t):
    return LIBRARY[path].encode(t or "", add_special_tokens=False).ids


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")


@settings(max_examples=300, deadline=None)
@given(text)
def test_coder_equals_library(t):
    for path in (WORD, BYTE):
        want = ids(path, t)
        coder = bpe.encoder(path)
        assert memoryview(coder.encode(t)).cast("I").tolist() == want
        assert bpe.counter(path).count(t) == len(want)
        if path == BYTE:
            assert coder.decode(coder.encode(t)) == LIBRARY[path].decode(want, skip_special_tokens=False)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), text), max_size=20))
def test_batches_equal_single_texts(texts):
    a = pa.array(texts, pa.string())
    assert [memoryview(x).cast("I").tolist() for x in bpe.encoder(WORD).encode_all(a)] == [ids(WORD, t) for t in texts]
    assert bpe.counter(WORD).count_all(a) == [len(ids(WORD, t)) for t in texts]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_long_pieces_take_the_heap(path):
    rng = random.Random(1)
    for n in (bpe.LONG_PIECE - 1, bpe.LONG_PIECE, 3000):
        t = "".join(rng.choice("abcdeth") for _ in range(n))
        assert memoryview(bpe.encoder(path).encode(t)).cast("I").tolist() == ids(path, t)


def test_caches_are_bounded():
    coder = bpe.TokenCounter(WORD, limit=50)
    words = [f"w{i}x" for i in range(500)]
    assert [coder.count(w) for w in words + words] == [len(ids(WORD, w)) for w in words + words]
    assert len(coder.unit) <= 50 and len(coder.unit.old) <= 50


def test_counts(spark):
    got = op1_token_counts.with_token_counts(docs(spark)).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted((str(d), len(ids(WORD, t))) for d, t, _ in ROWS)
    assert op1_token_counts.with_token_counts(docs(spark, [])).count() == 0


def test_counts_query(spark, sf_dir):
    rows = {r.doc_id: r for r in op1_token_counts.op1_token_counts(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        n = len(ids(WORD, r.text))
        assert (rows[r.doc_id].n_bytes, rows[r.doc_id].n_tokens, rows[r.doc_id].over_limit) == (len(r.text.encode()), n, n > 2048)


def test_codec(spark):
    got = docs(spark).select("doc_id", "text", op2_bpe_codec.round_trip("text").alias("r")).collect()
    for r in got:
        want = ids(BYTE, r.text)
        assert r.r.n_tokens == len(want)
        assert r.r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in want)).hexdigest()
        assert r.r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    both = docs(spark).select("text", op2_bpe_codec.encoded("text").alias("ids")).withColumn("back", op2_bpe_codec.decoded("ids"))
    assert all(r.ids == ids(BYTE, r.text) and r.back == (r.text or "") for r in both.collect())
    assert docs(spark, []).select(op2_bpe_codec.round_trip("text")).count() == 0


def test_codec_query(spark, sf_dir):
    rows = {r.doc_id: r for r in op2_bpe_codec.op2_bpe_codec(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        want, got = ids(BYTE, r.text), rows[r.doc_id]
        assert (got.n_tokens, got.ids_sha256) == (len(want), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in want)).hexdigest())
        assert got.decoded_sha256 == hashlib.sha256(LIBRARY[BYTE].decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_long_units_are_not_kept():
    counter = bpe.TokenCounter(WORD)
    texts = ["".join(random.Random(i).choices("abcdef", k=400)) for i in range(30)]
    assert [counter.count(t) for t in texts] == [len(ids(WORD, t)) for t in texts]
    assert not counter.unit and not counter.piece


def check_packing(pieces, texts, capacity=2048):
    """Every id lies in one piece, sequences have no gaps and no more than the capacity."""
    of_doc, of_seq = {}, {}
    for p in pieces:
        of_doc.setdefault(p.doc_id, []).append(p)
        of_seq.setdefault(p.sequence_id, []).append(p)
    for doc, t in texts:
        whole = [*ids(WORD, t), 1]
        at = 0
        for p in sorted(of_doc[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(whole)) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in whole[at : at + p.length]))
            at += p.length
        assert at == len(whole)
    for s in of_seq.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return sum(p.length for p in pieces), len(of_seq)


def test_packing(spark):
    rows = [(d if d is not None else -1, t, i) for i, (d, t, _) in enumerate(ROWS) if i != 3]
    pieces = op3_packing.pack(docs(spark, rows)).collect()
    check_packing(pieces, [(d, t) for d, t, _ in rows])
    assert op3_packing.pack(docs(spark, [])).count() == 0


def test_packing_repeated_rows_and_null_ids(spark):
    pieces = op3_packing.pack(docs(spark, [(None, "x", 1), (None, "x", 1), (7, None, 1)])).collect()
    assert sorted((str(p.doc_id), p.length) for p in pieces) == [("7", 1), ("None", 2), ("None", 2)]


@pytest.mark.parametrize("parts", [1, 5])
def test_packing_query_has_little_padding(spark, sf_dir, parts):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(parts)
    tokens, sequences = check_packing(op3_packing.pack(df).collect(), [(r.doc_id, r.text) for r in df.collect()])
    assert 1 - tokens / (2048 * sequences) < 0.02


def test_cuts_fill_their_classes():
    for r, pieces in enumerate(op3_packing.cuts()):
        assert sum(n for _, n in pieces) == r and len(pieces) <= 3
        assert all(2048 // (c + 1) < n <= 2048 // c or n <= 2048 // c for c, n in pieces)
        assert r < 64 or sum(2048 // c for c, _ in pieces) - r <= max(1, 0.03 * r)


def test_extra_columns_do_not_clash(spark):
    df = docs(spark).withColumns({"r": F.lit(1), "cls": F.lit(2), "worker": F.lit(3), "length": F.lit(4)})
    assert op3_packing.pack(df).count() > 0
    assert op1_token_counts.with_token_counts(df, out="length").columns == df.columns
