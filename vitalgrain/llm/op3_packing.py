"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Class j holds pieces of lengths in (C/(j+1), C/j], and each of its bins takes exactly j of them, so
a worker fills the bins of its own rows without seeing any other's. As documents may be cut, a
remainder is cut so that its parts lie at the tops of their classes: a full bin then loses at most
a few tokens. What stays in unfilled bins (fewer than j pieces a class and worker) is numbered
through over all workers and filled class by class; the last unfilled bin of each class, a bounded
set whatever the input, is packed first-fit by falling length.

Defined cases: a null or empty text is the end token alone; repeated rows are packed once each;
an empty table gives no pieces; a null doc_id stays null; further columns are not carried.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from .common import materialise, text_or_empty

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 1
#: Classes up to this one, of those whose full bins lose at most WASTE of the capacity.
CLASSES = 128
WASTE = 0.005
#: Sequence ids: workers count from partition << 32; the two later rounds have ranges of their own.
_ROUND_2, _ROUND_3 = 1 << 61, 1 << 62

_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("cls", pa.int32()), ("worker", pa.int32()), ("seat", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
_SPARK = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, cls int, worker int, seat long, sequence_id long, offset long"


@lru_cache
def cuts(capacity: int = CAPACITY, classes: int = CLASSES, waste: float = WASTE) -> list[tuple[tuple[int, int], ...]]:
    """For each remainder r below the capacity its pieces as (class, length): the fewest, up to three, that lose little."""
    tops = {capacity // j: j for j in range(min(classes, capacity), 0, -1) if capacity - j * (capacity // j) <= waste * capacity}
    sizes = sorted(tops)
    one = [0] * (capacity + 1)
    at = 0
    for r in range(1, capacity + 1):
        while sizes[at] < r:
            at += 1
        one[r] = sizes[at]
    best: list[list[tuple[int, ...]]] = [[(), *((one[r],) for r in range(1, capacity + 1))]]
    for _ in range(2):
        last = best[-1]
        best.append([min((last[r], *((a, *last[r - a]) for a in reversed(sizes) if a < r)), key=sum) for r in range(capacity)])
    out: list[tuple[tuple[int, int], ...]] = [()]
    for r in range(1, capacity):
        pick = next((b[r] for b in best if sum(b[r]) - r <= max(waste * r, 1)), best[-1][r])
        pieces, left = [], r
        for a in sorted(pick, reverse=True):
            if left > 0:
                pieces.append((tops[a], min(a, left)))
                left -= a
        out.append(tuple(pieces))
    return out


def _tokenised_pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, plan, end = bpe.encoder(path).encode_all, cuts(capacity), array("I", [END_ID]).tobytes()
        worker = TaskContext.get().partitionId()
        open_bins: dict[int, list[list]] = {}
        made = 0
        for batch in batches:
            rows: list[list] = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                ids += end
                n, start = len(ids) // 4, 0
                for cls, length in [(1, capacity)] * (n // capacity) + list(plan[n % capacity]):
                    row = [doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, cls, worker, None, None, None]
                    start += length
                    full = open_bins.setdefault(cls, [])
                    full.append(row)
                    if len(full) == cls:
                        at = 0
                        for x in full:
                            x[8], x[9] = (worker << 32) + made, at
                            at += x[2]
                        made += 1
                        rows += full
                        open_bins[cls] = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)
        rows = [[*x[:7], seat, None, None] for full in open_bins.values() for seat, x in enumerate(full)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)

    return run


def _first_fit(capacity: int):
    """The bounded rest: pieces in falling length, each into the first sequence with room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [list(r.values()) for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: (-r[2], r[0] is None, r[0] or 0, r[1], r[6], r[7]))
        room: list[int] = []
        for r in rows:
            i = next((i for i, x in enumerate(room) if x >= r[2]), len(room))
            if i == len(room):
                room.append(capacity)
            r[8], r[9] = _ROUND_3 + i, capacity - room[i]
            room[i] -= r[2]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)

    return run


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequence and the offset there."""
    path = path or public_tokenizers.path(VOCABULARY)
    if capacity < CLASSES:
        raise ValueError(f"capacity must be at least {CLASSES}")
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    pieces = materialise(narrow.mapInArrow(_tokenised_pieces(path, capacity), _SPARK), "pieces")
    done, left = pieces.where("seat is null"), pieces.where("seat is not null")

    counts = left.groupBy("cls", "worker").agg(F.count("*").alias("own"))
    by_worker = Window.partitionBy("cls").orderBy("worker")
    before = counts.select(
        "cls", "worker",
        (F.sum("own").over(by_worker) - F.col("own")).alias("before"),
        F.sum("own").over(Window.partitionBy("cls")).alias("all"),
    )
    ranked = left.join(before, ["cls", "worker"]).withColumn("rank", F.col("before") + F.col("seat"))
    bins = F.expr("rank div cls")
    fits = bins < F.expr("`all` div cls")
    in_bin = Window.partitionBy("cls", "bin").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    second = (
        ranked.where(fits).withColumn("bin", bins)
        .withColumn("offset", F.sum("length").over(in_bin) - F.col("length"))
        .withColumn("sequence_id", F.lit(_ROUND_2) + F.col("cls").cast("long") * (1 << 40) + F.col("bin"))
    )
    # below CLASSES ** 2 / 2 rows, for any input
    third = ranked.where(~fits).select(*left.columns).repartition(1).mapInArrow(_first_fit(capacity), _SPARK)
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return done.select(keep).unionByName(second.select(keep)).unionByName(third.select(keep))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
