"""Row sources that are computed, not read: ranges, spines, seeded columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def generate_rows(
    spark: SparkSession, n: int, cols: dict[str, Column], parts: int | None = None
) -> DataFrame:
    """``n`` rows with an ``id`` and the given columns, which may use ``id``."""
    return spark.range(0, n, 1, parts).select("id", *[c.alias(name) for name, c in cols.items()])


def time_spine(
    spark: SparkSession,
    start: datetime | str,
    end: datetime | str,
    step_us: int,
    out: str = "ts",
    parts: int | None = None,
) -> DataFrame:
    """Timestamps (no zone) from ``start`` up to and including ``end``, every
    ``step_us`` microseconds. Rows are computed in parallel from a range."""
    first, last = (datetime.fromisoformat(v) if isinstance(v, str) else v for v in (start, end))
    if step_us <= 0:
        raise ValueError("step_us must be above 0")
    span = last - first
    span_us = (span.days * 86_400 + span.seconds) * 1_000_000 + span.microseconds
    n = span_us // step_us + 1 if span_us >= 0 else 0
    begin = F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz")
    tick = F.timestamp_add("MICROSECOND", F.col("id") * F.lit(step_us), begin)
    return spark.range(0, n, 1, parts).select("id", tick.alias(out))


def date_series(spark: SparkSession, n: int) -> DataFrame:
    """Day offsets 0 .. n-1."""
    return spark.range(n).select(F.col("id").cast("int").alias("offset_days"))
