"""Session defaults shared by jobs, tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """SparkSession with the defaults above; ``conf`` keys use ``_`` for ``.``
    only when they hold no dot already (so plain Spark keys pass through)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key if "." in key else key.replace("_", "."), value)
    return builder.getOrCreate()
