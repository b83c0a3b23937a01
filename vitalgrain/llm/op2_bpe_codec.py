"""BPE encoding and decoding with contiguous rank arrays.

Each short piece keeps its parts and the ranks of adjacent parts in two arrays; the least rank is
found by a scan, the boundary goes, and the two neighbouring ranks are looked up anew. Pieces of
`bpe.LONG_PIECE` symbols or more take the heap, which gives the same ids without quadratic time.
Defined cases: a null or empty text has no ids and decodes to the empty text; special strings in a
text become their special id; any other column passes unchanged; an empty table stays empty.
"""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import text_or_empty

VOCABULARY = "byte_bpe_50k.json"


def encoded(text: str | Column = "text", path: str | None = None) -> Column:
    """Ids as array<int>."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        encode = bpe.encoder(path).encode
        return pa.array([memoryview(encode(x.as_py())).cast("i").tolist() for x in texts], pa.list_(pa.int32()))

    return ids(text_or_empty(text))


def decoded(ids: str | Column, path: str | None = None) -> Column:
    """The text of an array<int> of ids; null ids decode to the empty text."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.arrow_udf("string")
    def texts(column: pa.Array) -> pa.Array:
        table = bpe.encoder(path).merges.bytes_of
        return pa.array([b"".join(map(table.__getitem__, x.as_py() or ())).decode("utf-8", "replace") for x in column], pa.string())

    return texts(F.col(ids) if isinstance(ids, str) else ids)


def round_trip(text: str | Column = "text", path: str | None = None) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256) of a text encoded and decoded in one pass.

    The ids stay in the worker: at 100 TB they would be as much data again.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pa.Array) -> pa.Array:
        coder, sha = bpe.encoder(path), hashlib.sha256
        rows = []
        for x in texts:
            ids = coder.encode(x.as_py())
            rows.append((len(ids) // 4, sha(ids).hexdigest(), sha(coder.decode(ids).encode("utf-8", "surrogatepass")).hexdigest()))
        return pa.array([dict(zip(("n_tokens", "ids_sha256", "decoded_sha256"), r)) for r in rows], kind)

    return digests(text_or_empty(text))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", round_trip("text").alias("r")).select("doc_id", "r.*")
