"""Helpers that several operators share: intermediate tables, digests, bounded caches, hot keys."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

#: Word separators of every contract: the space and the five ASCII controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"

#: Rows that a task of a narrow intermediate table writes at least.
TASK_ROWS = 20_000
#: Documents that a Python worker gets at once while a table is written.
BATCH_ROWS = 2_000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialise(df: DataFrame, name: str, rows: int | None = None, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage ends here, and a lost executor loses nothing.

    `rows`, a bound on the rows of a narrow table, keeps a small one from being written as many tiny files.
    `batch_rows` bounds the rows that a Python worker gets at once.
    """
    spark = df.sparkSession
    if rows is not None:
        parts = max(2 * spark.sparkContext.defaultParallelism, rows // TASK_ROWS)
        if parts < int(spark.conf.get("spark.sql.shuffle.partitions")):
            df = df.coalesce(parts)
    path = scratch_path(spark, name)
    batch = int(spark.conf.get(_BATCH_KEY))
    spark.conf.set(_BATCH_KEY, min(batch, batch_rows) if batch > 0 else batch_rows)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_KEY, batch)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def n_bytes(col: str | Column = "text") -> Column:
    return F.octet_length(text_or_empty(col)).cast("long")


class RecentCache(dict):
    """A dict that computes what it lacks and holds at most two generations of `limit` entries.

    Rare words fill a plain cache without end; here the older generation goes as a whole,
    and what is asked for again moves to the younger one. Keys longer than `longest` are computed
    each time, so that texts without white space can't fill the memory.
    """

    def __init__(self, compute: Callable, limit: int = 250_000, longest: int = 64):
        super().__init__()
        self.compute, self.limit, self.longest, self.old = compute, limit, longest, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.compute(key)
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value


def scratch(stem: str, taken: list[str]) -> str:
    """A column name that no column of the input has."""
    name = f"__{stem}"
    while name in taken:
        name = f"_{name}"
    return name


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, hot_groups: int = 1024, written: bool = False) -> DataFrame:
    """Left-joins `groups` (one row a key, with its number of rows in `size`) to `rows`, safe under skew.

    A group with more than total / hot_groups rows is hot; there are at most hot_groups of them, so
    their few rows are broadcast. All other groups are small enough for an ordinary join. Where
    `groups` is a written table, a look at it may find that none is hot, and one join is enough.
    """
    heavy = F.col(size) > F.lit(total / hot_groups)
    if written and groups.where(heavy).isEmpty():
        return rows.join(groups, key, "left")
    hot, cold = groups.where(heavy), groups.where(~heavy)
    many = rows.join(F.broadcast(hot), key, "inner")
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, "left")
    return many.unionByName(rest)


def word_units(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The units between ASCII white space, each distinct one once, and where each text's units begin."""
    units = pc.ascii_split_whitespace(texts)
    starts = units.offsets.to_numpy()
    return starts - starts[0], units.flatten().dictionary_encode()


def slices(texts: pa.Array, size: int = 4 << 20) -> Iterator[pa.Array]:
    """Runs of texts of about `size` bytes, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        yield texts.slice(at, max(1, upto - at))
        at = max(upto, at + 1)
    _give_back()


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None


def _give_back() -> None:
    """Returns freed memory to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words between SPACES, A-Z lower-cased, and the index of each text's first word (and the end)."""
    starts, units = word_units(pc.ascii_lower(texts))
    words = units.dictionary
    each = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))
    empty = pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    index = units.indices.to_numpy(zero_copy_only=False)
    if empty.any():  # leading and trailing separators
        keep = ~empty[index]
        upto = np.concatenate([[0], np.cumsum(keep)])
        return upto[starts], each[index[keep]]
    return starts.astype(np.int64), each[index]


#: Share of the smaller of driver and executor memory that the two tables of a filter may take when broadcast.
FILTER_SHARE = 16


def filter_bits(spark: SparkSession) -> int:
    """Bound of each filter table's cells. A 64-bit word of them is broadcast only if one of its cells is set, and takes some 64 bytes then."""
    context = spark.sparkContext
    jvm = context._jvm
    own = jvm.Runtime.getRuntime().maxMemory()
    heap = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(context.getConf().get("spark.executor.memory", "1g"))
    local = context.master == "local" or context.master.startswith("local[")
    return 1 << max(10, (own if local else min(own, heap)) // (2 * FILTER_SHARE)).bit_length()


def member_filter(ids: DataFrame, column: str, total: int, bound: int | None = None) -> tuple[DataFrame, int]:
    """A Bloom filter of the ids as (word, bits), two cells an id; at most 2 * bound cells."""
    bound = bound or filter_bits(ids.sparkSession)
    cells = 1 << 10
    while cells < min(bound, 16 * total):
        cells *= 2
    hits = ids.select(F.explode(F.array(*filter_cells(column, cells))).alias("cell"))
    return filter_words(hits, 2 * total), cells


def filter_cells(column: str, cells: int) -> list[Column]:
    return [F.pmod(F.xxhash64(column, F.lit(i)), F.lit(cells)) + i * cells for i in range(2)]


def filter_words(hits: DataFrame, rows: int | None = None) -> DataFrame:
    words = hits.groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("bits"))
    return materialise(words, "filter", rows)


def filter_test(rows: DataFrame, column: str, words: DataFrame, cells: int) -> DataFrame:
    """Adds the boolean `__maybe`: false only where the filter lacks the value. `words` has 2 * cells bits at most."""
    out = rows
    for i, cell in enumerate(filter_cells(column, cells)):
        table = words.select(F.col("word").alias(f"__word{i}"), F.col("bits").alias(f"__bits{i}"))
        out = out.withColumn(f"__cell{i}", cell)
        out = out.join(F.broadcast(table), F.shiftright(f"__cell{i}", 6) == F.col(f"__word{i}"), "left")
    hit = [F.expr(f"coalesce((shiftrightunsigned(__bits{i}, cast(__cell{i} & 63 as int)) & 1) = 1, false)") for i in range(2)]
    return out.select(*rows.columns, (hit[0] & hit[1]).alias("__maybe"))
