"""Exact deduplication with two passes over a Bloom filter of possibly repeated digests.

The text is read once, into a narrow table of digests. Pass one counts how many rows fall on each
cell of two hash tables and keeps the cells that two rows or more hit, as 64-bit words. Pass two
tests each row's two cells: a row that misses is unique for certain and goes straight to the
result; only the others shuffle, and their full SHA-256 decides. The filter's size is bounded by the
executors' memory (`common.filter_bits`). Where the rows ask for more cells, the narrow table is
written again in ranges of digests, each with a filter of its own, one after the other, so the share
of rows that pass straight through is the same at any size.

Defined cases: a null text equals the empty one; of rows with equal text the smallest doc_id stays,
null ids last, and of rows that repeat the id as well just one; an empty table stays empty; other
columns are not needed, and `deduplicate` returns them unchanged for the rows it keeps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .common import attach_groups, filter_bits, filter_cells, filter_test, filter_words, materialise, member_filter, text_or_empty

CELLS_A_ROW = 16


def normalised(text: str | Column = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", " ")


def repeat_filter(digests: DataFrame, digest: str, total: int, bound: int | None = None) -> tuple[DataFrame, int]:
    """Pass one: (word, bits) of the cells that two rows or more hit, and the cells of each table."""
    bound = bound or filter_bits(digests.sparkSession)
    cells = 1 << 10
    while cells < min(bound, CELLS_A_ROW * total):
        cells *= 2
    hits = digests.select(F.explode(F.array(*filter_cells(digest, cells))).alias("cell")).groupBy("cell").agg(F.count("*").alias("hits"))
    return filter_words(hits.where("hits > 1"), 2 * total), cells


#: Pass two: adds the boolean `__maybe`, false only where no other row has the same digest.
possibly_repeated = filter_test


def _sha(text: str) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def _groups(maybe: DataFrame) -> DataFrame:
    """Of each digest on two rows or more: rows, the id that stays, its first row, and how many rows carry that id."""
    by_id = maybe.groupBy("sha", "doc_id").agg(F.count("*").alias("n"), F.min("row").alias("row"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "n"))
    groups = by_id.groupBy("sha").agg(F.sum("n").alias("size"), first.alias("first")).where("size > 1")
    return materialise(groups.select("sha", "size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), F.col("first.n").alias("same_id")), "groups")


def _ranges(digests: DataFrame, total: int, bound: int) -> list[tuple[DataFrame, int]]:
    """The digests and their number, in ranges that a filter of `bound` cells is large enough for."""
    count = -(-CELLS_A_ROW * total // bound)
    if count <= 1:
        return [(digests, total)]
    spark = digests.sparkSession
    path = scratch_path(spark, "ranges")
    digests.withColumn("range", F.pmod(F.xxhash64("sha", F.lit("range")), F.lit(count))).write.partitionBy("range").parquet(path)
    # each range is a folder of its own, so reading one reads no other
    table = spark.read.parquet(path)
    sizes = table.groupBy("range").agg(F.count("*").alias("n")).collect()  # a row a range
    return [(table.where(F.col("range") == r["range"]).drop("range"), r["n"]) for r in sizes]


def _decided(digests: DataFrame, total: int, bound: int) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of one range."""
    tested = possibly_repeated(digests, "sha", *repeat_filter(digests, "sha", total, bound))
    maybe = tested.where("__maybe").drop("__maybe")
    joined = attach_groups(maybe, _groups(maybe), "sha", "size", total)
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    alone = F.col("size").isNull()
    repeated = joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        sha,
    )
    unique = tested.where("not __maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)
    return unique.unionByName(repeated)


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bound: int | None = None) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = materialise(docs.select(F.col(doc_id).alias("doc_id"), _sha(text).alias("sha"), F.monotonically_increasing_id().alias("row")), "digests")
    bound = bound or filter_bits(docs.sparkSession)
    ranges = _ranges(digests, digests.count(), bound)
    if len(ranges) == 1:
        return _decided(*ranges[0], bound)
    return reduce(DataFrame.unionByName, (materialise(_decided(part, n, bound), "decided") for part, n in ranges))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bound: int | None = None) -> DataFrame:
    """The rows that stay, with all their columns; a row that the filter calls unique never shuffles.

    Of rows that repeat both id and text, the least by their other columns' hash stays.
    """
    digests = materialise(docs.select(F.col(doc_id).alias("doc_id"), _sha(text).alias("sha"), F.lit(0).alias("row")), "digests")
    total = digests.count()
    bound = bound or filter_bits(docs.sparkSession)
    ranges = _ranges(digests, total, bound)
    found = []
    for part, n in ranges:
        words, cells = repeat_filter(part, "sha", n, bound)
        found.append(_groups(possibly_repeated(part, "sha", words, cells).where("__maybe").drop("__maybe")).drop("keep_row"))
    groups = reduce(DataFrame.unionByName, found)
    if len(ranges) > 1:  # one filter over all ranges, of the repeated digests alone
        words, cells = member_filter(groups, "sha", groups.count(), bound)
    names = docs.columns
    own = [f"c{i}" for i in range(len(names))]
    whole = docs.toDF(*own).withColumn("sha", _sha(own[names.index(text)]))
    tested = possibly_repeated(whole, "sha", words, cells)
    joined = attach_groups(tested.where("__maybe"), groups, "sha", "size", total)
    alone = F.col("size").isNull()
    stays = F.col(own[names.index(doc_id)]).eqNullSafe(F.col("keep_id"))
    one = joined.where(alone | (stays & (F.col("same_id") == 1))).select(own)
    several = joined.where(~alone & stays & (F.col("same_id") > 1)).groupBy("sha").agg(F.min_by(F.struct(*own), F.xxhash64(*own)).alias("row")).select("row.*")
    return tested.where("not __maybe").select(own).unionByName(one).unionByName(several).toDF(*names)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
with t as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as h from documents)
select doc_id, min(doc_id) over (partition by h) as keep_id, count(*) over (partition by h) as group_size,
       doc_id = min(doc_id) over (partition by h) as kept, h as text_sha256
from t
"""
