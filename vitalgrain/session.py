"""Spark sessions with the settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "vitalgrain", **options: str) -> SparkSession:
    """A session with UTC, ANSI SQL and adaptive execution; `options` are further Spark settings, dots as underscores."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # generated methods of more bytes than this are never compiled by the JVM, so plain evaluation is faster
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for key, value in options.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()
