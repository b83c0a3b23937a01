"""From raw documents to packed training sequences: language, exact copies, near copies, packing.

Each stage takes all rows that the one before kept, reread from Parquet, and its decisions take
effect: documents of no recognised language go, of equal texts one stays, of each near-duplicate
component one stays, and what is left is packed. All but the last return the columns of documents.

Defined cases, at each stage for every row that it gets: null and empty texts and texts without
letters have no language and go; texts of any length are read whole; of rows that repeat a text the
smallest id stays (null ids last, then any one row); of near copies the smallest id of the component
stays, decided by row, so that a text whose id another row repeats is kept; ids may be null or repeat
with different texts; columns beyond those of documents pass unchanged up to packing, whatever their
names; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitalgrain.llm.common import materialise
from vitalgrain.llm.op3_packing import pack
from vitalgrain.llm.op5_language import identified
from vitalgrain.llm.op6_exact_dedup import deduplicate
from vitalgrain.llm.op9_near_dedup import kept_documents


#: Documents that a Python worker gets at once. Workers and executors live through all stages, so what
#: one stage needs at its peak adds to what the others have left behind.
BATCH_ROWS = 1000


_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """The stages are lazy, so the setting holds until what they return is written; run() puts it back."""
    spark.conf.set(_BATCH_KEY, BATCH_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return kept_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: SQL can express neither the language model nor the similarity join.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = spark.conf.get(_BATCH_KEY)
    try:
        for name, stage in STAGES[:-1]:
            docs = materialise(stage(spark, docs, sf_dir), name)
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:
        spark.conf.set(_BATCH_KEY, before)
