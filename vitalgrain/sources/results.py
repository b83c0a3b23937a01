"""A set of result tables that is replaced as a whole, or not at all.

A run writes its tables to a folder of its own and then names that folder in the manifest `_current`,
which a rename puts in place in one step. Readers go by the manifest, so they see the tables of the run
before or of this one, never a mixture. A run that is killed leaves a folder that no manifest names;
the next run removes it. Tasks that are repeated write nothing twice, as Spark commits each task's files
once. One run at a time writes to a path.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_MANIFEST = "_current"
_RUN = "run-"


def _files(spark: SparkSession, path: str):
    """The file system's context, and a maker of its paths."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = fs.Path(path)
    full = root.getFileSystem(conf).makeQualified(root)
    return fs, fs.FileContext.getFileContext(full.toUri(), conf), full


def _manifest(spark: SparkSession, path: str) -> dict | None:
    fs, files, root = _files(spark, path)
    place = fs.Path(root, _MANIFEST)
    if not files.util().exists(place):
        return None
    stream = files.open(place)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, manifest: dict) -> None:
    """Puts a manifest in place of the one before by a rename."""
    fs, files, root = _files(spark, path)
    gateway = spark.sparkContext._gateway
    draft = fs.Path(root, f"{_MANIFEST}.{manifest['run']}")
    out = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(draft, True)
    try:
        out.write(bytearray(json.dumps(manifest).encode()))
    finally:
        out.close()
    overwrite = gateway.new_array(gateway.jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = gateway.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(draft, fs.Path(root, _MANIFEST), overwrite)


def _clean(spark: SparkSession, path: str, keep: str | None) -> None:
    """Removes the folders and drafts of other runs."""
    fs, files, root = _files(spark, path)
    if not files.util().exists(root):
        return
    for status in files.util().listStatus(root):
        name = status.getPath().getName()
        if name != keep and (name.startswith(_RUN) or name.startswith(f"{_MANIFEST}.{_RUN}")):
            files.delete(status.getPath(), True)


def write_results(tables: dict[str, DataFrame], path: str, partition_by: dict[str, str] | None = None) -> dict:
    """Replaces the tables under a path, each partitioned by its column in `partition_by`, and returns the manifest."""
    spark = next(iter(tables.values())).sparkSession
    before = _manifest(spark, path)
    _clean(spark, path, before and before["run"])
    manifest = {"run": f"{_RUN}{uuid.uuid4().hex}", "tables": {}}
    for name, df in tables.items():
        writer = df.write
        if by := (partition_by or {}).get(name):
            writer = writer.partitionBy(by)
        writer.parquet(f"{path}/{manifest['run']}/{name}")
        manifest["tables"][name] = df.schema.jsonValue()
    _commit(spark, path, manifest)
    _clean(spark, path, manifest["run"])
    return manifest


def read_results(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table of the last whole run. FileNotFoundError if there is none."""
    manifest = _manifest(spark, path)
    if manifest is None or table not in manifest["tables"]:
        raise FileNotFoundError(f"no results of {table} in {path}")
    # columns come back in their order, with a partition's column in its place
    schema = StructType.fromJson(manifest["tables"][table])
    return spark.read.schema(schema).parquet(f"{path}/{manifest['run']}/{table}").select(*(f"`{n}`" for n in schema.names))
