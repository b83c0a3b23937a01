"""Document fingerprints: SimHash over word triples, and search by permuted block tables.

Each distinct triple of words votes on 128 signed bits with the weight 1 + ln(times it occurs); a
bit is set where the sum is positive. Equal texts have equal fingerprints, and the share of equal
bits of two fingerprints falls with the angle between the texts' term vectors.

The neighbour query needs every document beside the next lower id. Rows go once into buckets of the
id's range, those of an id that many rows have (null, too) into buckets of their text's hash; the one
row that a bucket needs from the bucket below is sent along as a copy, so the text shuffles once and
no window spans the table.

Defined cases: null or empty texts have no terms and the fingerprint 0; texts of fewer than three
words are one term; null ids follow the smallest id; rows that repeat an id follow each other by
the text's hash, and by text where hashes are equal, whatever the number of partitions; the only
document of a table is its own neighbour; an empty table gives no rows; further columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import RecentCache, text_or_empty

BITS = 128
TERM_WORDS = 3
#: Odd multipliers that mix word hashes into term hashes.
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_S = [np.uint64(x) for x in (29, 32, 33)]


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ (h >> _S[2])) * _MIX[salt]
    h = (h ^ (h >> _S[0])) * _MIX[salt + 1]
    return h ^ (h >> _S[1])


class SimHash:
    """Fingerprints of texts; `limit` bounds the words whose hashes a worker remembers."""

    def __init__(self, limit: int = 200_000):
        self.word = RecentCache(xxhash.xxh3_64_intdigest, limit)

    def terms(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        if not words:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        h = np.fromiter(map(self.word.__getitem__, words), np.uint64, len(words))
        k = min(TERM_WORDS, len(h))
        n = len(h) - k + 1
        out = np.full(n, np.uint64(k))
        for i in range(k):
            out = out * _MIX[0] + (h[i : n + i] ^ (h[i : n + i] >> _S[0])) * _MIX[i + 1]
        return np.unique(out, return_counts=True)

    def votes(self, text: str) -> np.ndarray:
        terms, counts = self.terms(text)
        total = np.zeros(BITS)
        for i in range(0, len(terms), 8192):
            t = terms[i : i + 8192]
            weight = 1 + np.log(counts[i : i + 8192]).astype(np.float32)
            raw = np.stack([_mixed(t, 2), _mixed(t, 4)], axis=1).view(np.uint8)
            bits = np.unpackbits(raw, axis=1).astype(np.float32)
            total += 2 * (weight @ bits) - weight.sum()
        return total

    def of(self, text: str | None) -> bytes:
        """The fingerprint, 16 bytes."""
        return np.packbits(self.votes(text or "") > 1e-3).tobytes()


def hamming(a: bytes, b: bytes) -> int:
    return (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()


def likeness(a: bytes, b: bytes) -> float:
    return 1 - hamming(a, b) / BITS


_OWN: list[SimHash] = []


def _simhash() -> SimHash:
    if not _OWN:
        _OWN.append(SimHash())
    return _OWN[0]


def fingerprint(text: str | Column = "text") -> Column:
    """The fingerprint of a text as 32 hexadecimal digits."""

    @F.arrow_udf("string")
    def made(texts: pa.Array) -> pa.Array:
        return pa.array([_simhash().of(x.as_py()).hex() for x in texts], pa.string())

    return made(text_or_empty(text))


def within_radius(prints: DataFrame, fingerprint: str = "fingerprint", radius: int = 6, blocks: int = 8) -> DataFrame:
    """All pairs a < b of distinct fingerprints that differ in at most `radius` bits, with their distance.

    The bits are cut into blocks; two such fingerprints agree on `blocks - radius` whole blocks at
    least, so each table sorts the fingerprints by one choice of that many blocks and only rows that
    agree there are compared. Copies share a fingerprint and are one row here.
    """
    agree = blocks - radius
    if agree < 1:
        raise ValueError("blocks must exceed radius")
    distinct = prints.select(F.lower(F.col(fingerprint)).alias("print")).where("print is not null").distinct()
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    bits = F.concat(*(F.lpad(F.conv(F.substring("print", 1 + 8 * i, 8), 16, 2), 32, "0") for i in range(BITS // 32)))
    tables = F.array(
        *(
            F.struct(F.lit(t).alias("t"), F.concat(*(F.substring("bits", 1 + edges[b], edges[b + 1] - edges[b]) for b in chosen)).alias("key"))
            for t, chosen in enumerate(combinations(range(blocks), agree))
        )
    )
    keyed = distinct.withColumn("bits", bits).select("print", F.explode(tables).alias("k")).select("print", F.xxhash64("k.t", "k.key").alias("key"))
    a, b = keyed.select("key", F.col("print").alias("a")), keyed.select("key", F.col("print").alias("b"))
    words = [(F.conv(F.substring("a", 1 + 8 * i, 8), 16, 10).cast("long"), F.conv(F.substring("b", 1 + 8 * i, 8), 16, 10).cast("long")) for i in range(BITS // 32)]
    distance = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in words[1:]), F.bit_count(words[0][0].bitwiseXOR(words[0][1])))
    return a.join(b, "key").where("a < b").select("a", "b", distance.alias("distance")).where(F.col("distance") <= radius).distinct()


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_OUT_SPARK = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _row(doc, text: str, own: bytes, after: str, after_print: bytes) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    print_ = _simhash().of(edited)
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return doc, len(text), sha, own.hex(), print_.hex(), likeness(own, print_), likeness(own, after_print)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by bucket, in falling order of the id, and last the copy from the bucket below."""
    held = None  # the row whose successor comes next: bucket, id, text, fingerprint
    for batch in batches:
        rows = []
        for bucket, copy, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if held is None and copy:
                continue
            own = _simhash().of(text)
            if held is not None:
                rows.append(_row(*held[1:], text, own))
            held = None if copy else (bucket, doc, text, own)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)], schema=_OUT)


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness; columns as in the contract."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 8 * parts
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    quantiles = F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 10 * buckets)
    # one number a bucket; an id with the rows of several is there several times
    found = rows.agg(quantiles.alias("q"), F.count("*").alias("rows"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    bounds, spans = np.unique(np.array(found["q"] or [], np.int64), return_counts=True)
    null_span = -(-found["nulls"] * buckets // max(1, found["rows"]))
    spans = np.append(np.where(spans > 1, spans, 0), 0)
    width = int(max(spans.max(), null_span)) + 1
    # rows that repeat an id follow each other by the hash of their text, and where an id spans buckets, it is cut by that
    by_text = F.shiftrightunsigned(F.xxhash64("text"), 1)
    order = by_text if width > 1 else F.lit(0).cast("long")

    @F.arrow_udf("long")
    def bucket_of(ids: pa.Array, order: pa.Array) -> pa.Array:
        known, none = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
        at = np.searchsorted(bounds, known, "left")
        own = np.append(bounds, 0)[at] == known
        span = np.where(none, null_span, np.where(own, spans[at], 0))
        part = span - (span * (order.to_numpy() >> 32) >> 31)  # from span down to 1, as the hash grows
        return pa.array(np.where(none, 0, at + 1) * width + part)

    placed = rows.withColumn("order", order).withColumn("bucket", bucket_of("doc_id", "order"))
    # a row a bucket: its first one, which the next bucket above that has rows needs as a copy
    first = F.max(F.struct("doc_id", F.bitwise_not("order").alias("order")))
    tops = sorted((r["bucket"], r["top"]["doc_id"], ~r["top"]["order"]) for r in placed.groupBy("bucket").agg(first.alias("top")).collect())
    above = [(*top, tops[(i + 1) % len(tops)][0]) for i, top in enumerate(tops)]
    table = spark.createDataFrame(above, "bucket long, top long, top_order long, above long")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("copy"))
    copy = F.struct(F.col("above").alias("bucket"), F.lit(True).alias("copy"))
    is_first = F.col("doc_id").eqNullSafe(F.col("top")) & (F.col("order") == F.col("top_order"))
    sent = placed.join(F.broadcast(table), "bucket").select("doc_id", "order", "text", F.explode(F.when(is_first, F.array(own, copy)).otherwise(F.array(own))).alias("to"))
    dealt = sent.select("to.bucket", "to.copy", "doc_id", "text", by_text.alias("order")).repartition(parts, "bucket")
    ordered = dealt.sortWithinPartitions("bucket", "copy", F.col("doc_id").desc_nulls_last(), "order", "text")
    return ordered.mapInArrow(_neighbours, _OUT_SPARK)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
