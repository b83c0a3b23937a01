"""Intermediate tables in a folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """What the cluster names in spark.checkpoint.dir; a temporary folder only where all of Spark runs on this machine."""
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder, as the master is {master}")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="vitalgrain-"))
    return _OWN[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path there, deleted when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written and reread: its rows and their order within files stay as they are."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
