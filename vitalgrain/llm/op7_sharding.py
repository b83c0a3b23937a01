"""Sharding by proportional stratified interleaving, law `rows`.

Rows are ranked in a seeded shuffle within their source; a row's fractional rank
(rank - phase) / rows_of_source, with a phase in (0, 1) drawn from the source's name, spreads each
source evenly over [0, 1); the order by fractional rank is cut into equal runs, so each shard has
the mixture of the whole. Both ranks are exact and made in two levels: rows are counted by
(source, key bucket) and by fraction bucket, the counts are summed up, and only the rows of one
bucket are sorted together. A hot source thus falls into as many buckets as its share asks for.

Defined cases: a null text has no bytes; a null source is a stratum of its own; null ids get their
key from size and checksum, so they spread too; repeated rows are placed once each; an empty table stays
empty. Other columns and the text are not carried: a table is written as shards by joining the result
to it by doc_id, where ids are unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, n_bytes, text_or_empty

SHARDS = 24
SEED = "interleave-1"
#: Rows that a bucket holds in the mean on large inputs.
BUCKET_ROWS = 50_000


def _unit(digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest as a number in [0, 2**32)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def shards(docs: DataFrame, count: int = SHARDS, seed: str = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot, grown_shard."""
    name = F.col(source).cast("string")
    narrow = docs.select(F.col(doc_id).alias("doc_id"), name.alias("source"), (n_bytes(text) + 8).alias("size"), F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32"))
    own = F.coalesce(F.col("doc_id").cast("string"), F.concat_ws(":", F.lit("null"), "size", "text_crc32"))
    rows = materialise(narrow.withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), own).cast("binary"))), "shard-rows")
    total = rows.count()
    buckets = max(64, total // BUCKET_ROWS)

    keyed = rows.withColumn("bucket", F.expr(f"shiftright({_sql_unit('key')} * {buckets}, 32)")).withColumn("stratum", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")))
    counts = keyed.groupBy("stratum", "bucket").agg(F.count("*").alias("own"))
    upto = Window.partitionBy("stratum").orderBy("bucket")
    before = counts.select(
        "stratum", "bucket",
        (F.sum("own").over(upto) - F.col("own")).alias("before"),
        F.sum("own").over(Window.partitionBy("stratum")).alias("rows_of_source"),
    )
    local = Window.partitionBy("stratum", "bucket").orderBy("key", "doc_id", "size", "text_crc32")
    phase = (_unit(F.md5(F.concat(F.lit(seed), "stratum").cast("binary"))) + 0.5) / F.lit(float(1 << 32))
    ranked = materialise(
        keyed.withColumn("local", F.row_number().over(local))
        .join(before, ["stratum", "bucket"])
        .withColumn("rank", F.col("before") + F.col("local"))
        .withColumn("fraction", (F.col("rank") - phase) / F.col("rows_of_source"))
        .select("doc_id", "source", "stratum", "size", "text_crc32", "rank", "fraction"),
        "shard-ranks",
    )

    cut = ranked.withColumn("part", F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1)))
    sums = cut.groupBy("part").agg(F.count("*").alias("own"))
    # one row a bucket; their running sum is the only window over one partition
    running = Window.partitionBy(F.lit(0)).orderBy("part")
    starts = sums.select("part", (F.sum("own").over(running) - F.col("own")).alias("before"))
    within = Window.partitionBy("part").orderBy("fraction", "stratum", "rank")
    placed = cut.withColumn("local", F.row_number().over(within) - 1).join(starts, "part").withColumn("at", F.col("before") + F.col("local"))
    shard = F.expr(f"(at * {count}) div {max(total, 1)}")
    return placed.select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"),
        (F.col("at") - F.expr(f"(((at * {count}) div {max(total, 1)}) * {total} + {count - 1}) div {count}")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _sql_unit(column: str) -> str:
    return f"cast(conv(substring({column}, 1, 8), 16, 10) as bigint)"


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("source")


ORACLE = f"""
with tab as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
h as (select doc_id, source, encode(coalesce(text, '')) as raw from documents),
b as (select doc_id, source, octet_length(raw) + 8 as size, list_transform(regexp_extract_all(hex(raw), '..'), lambda x: cast('0x' || x as bigint)) as b from h),
c as (select *, md5('{SEED}:' || coalesce(cast(doc_id as varchar), 'null:' || size || ':' || text_crc32)) as key, stratum
      from (select doc_id, size, xor(list_reduce(list_prepend(4294967295::bigint, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) as text_crc32, coalesce('s' || source, '-') as stratum from b, tab)),
r as (select *, row_number() over (partition by stratum order by key, doc_id, size, text_crc32) as rank, count(*) over (partition by stratum) as n from c),
f as (select *, (rank - (cast('0x' || substr(md5('{SEED}' || stratum), 1, 8) as bigint) + 0.5::double) / 4294967296::double) / n as fraction, count(*) over () as total from r),
p as (select *, row_number() over (order by fraction, stratum, rank) - 1 as pos from f)
select doc_id, cast(size as bigint) as size, cast(text_crc32 as bigint) as text_crc32, 'rows' as law, cast(pos * {SHARDS} // total as int) as shard,
       cast(pos - ((pos * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS} as bigint) as slot, cast(null as int) as grown_shard
from p
"""
