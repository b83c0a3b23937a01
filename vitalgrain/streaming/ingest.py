"""Profiles of a stream of files: each micro-batch adds its counts, the profile is their sum."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import profile


def missing_counts_stream(spark: SparkSession, source: str, schema: StructType, counts: str, checkpoint: str, file_format: str = "parquet") -> StreamingQuery:
    """Appends (batch_id, position, column_name, missing_count, rows) of each micro-batch to a Parquet table.

    A batch that runs again after a failure overwrites its own partition, so counts stay exact.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        part = profile.missing_summary(batch).drop("missing_ratio")
        part.coalesce(1).write.mode("overwrite").parquet(f"{counts}/batch_id={batch_id}")

    stream = spark.readStream.format(file_format).schema(schema).load(source)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def missing_summary_so_far(spark: SparkSession, counts: str) -> DataFrame:
    """The missing-value profile over all micro-batches."""
    total = spark.read.parquet(counts).groupBy("position", "column_name").agg(F.sum("missing_count").alias("missing_count"), F.sum("rows").alias("rows"))
    return total.withColumn("missing_ratio", F.try_divide(F.col("missing_count").cast("double"), F.col("rows"))).orderBy(F.desc("missing_ratio"), "position")
