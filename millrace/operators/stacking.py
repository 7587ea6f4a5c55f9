"""Multiply a table by date shifting, and stack tables by column name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.timetext import shift_days


def stack_days(df: DataFrame, n: int, date_cols: Sequence[str], offset: str | None = None) -> DataFrame:
    """Every row ``n`` times, copy k with ``date_cols`` moved by k days (k = 0..n-1).

    The offsets come from one constant array, so the copies are made next to the
    scan: no join and no shuffle. Keep the offset by naming it in ``offset``.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    name = offset or "__days"
    copies = df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    shifted = {}
    for col in date_cols:
        is_date = df.schema[col].dataType.typeName() == "date"
        shifted[col] = F.date_add(col, F.col(name)) if is_date else shift_days(col, name)
    out = copies.withColumns(shifted)
    return out if offset else out.drop(name)


def stack_tables(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
