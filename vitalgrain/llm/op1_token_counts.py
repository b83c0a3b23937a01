"""Token counts by heap-and-linked-list byte-pair merging.

The count of a piece is its initial symbols minus the merges made; no identifier is emitted.
Defined cases: a null or empty text has 0 tokens; repeated rows and ties are counted row by row;
an empty table gives an empty table; other columns, whatever their names, pass unchanged.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import n_bytes, text_or_empty

VOCABULARY = "word_bpe_49k.json"
LIMIT_TOKENS = 2048


def token_count(text: str | Column = "text", path: str | None = None, cache: int = 250_000) -> Column:
    """A column with the number of tokens of a text; `cache` bounds the words that a worker remembers."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        count = bpe.counter(path, cache).count
        return pa.array([count(x.as_py()) for x in texts], pa.int64())

    return counted(text_or_empty(text))


def with_token_counts(df: DataFrame, text: str = "text", out: str = "n_tokens", path: str | None = None) -> DataFrame:
    """Adds (or replaces) the column `out`; all else of the table stays as it is."""
    return df.withColumn(out, token_count(text, path))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counted = with_token_counts(docs.select("doc_id", "text", n_bytes().alias("n_bytes")))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT_TOKENS).alias("over_limit"))
